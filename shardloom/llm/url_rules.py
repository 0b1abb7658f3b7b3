"""URL filter: fixed host and path rules, then rules mined from labels.

1. A url is cut into host and path; of the fixed rules that fit, the longest
   decides.
2. Urls become sets of tokens (host labels, path words, query parts, numbers
   as ``<num>``).  FP-growth mines the token sets of labelled urls, with the
   label as one more token; association rules that imply it are kept if their
   confidence and support are high enough and no part of their tokens already
   gives a rule of that confidence.
3. Each mined rule stands in an inverted index under its rarest token.  Urls
   meet rules there by an equi-join, and a rule fires if all its tokens are in
   the url's set.

Defined results: a null url, or one without ``://``, has empty host and path
and no rule; it is allowed unless its tokens say otherwise; labels that
disagree count as bad; without labelled urls nothing is mined; repeated rows
are judged each; a url of any length is judged whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

# Fixed values: (host, path, action)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
BAD = "<bad>"


@dataclass(frozen=True)
class Mining:
    support: float = 0.002        # share of the labelled urls that a rule's tokens and label have
    least: int = 20               # and at least so many
    confidence: float = 0.8


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path, both empty without ``://``."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, shape, i), F.lit(""))
    return F.translate(part(1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), part(2)


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """``host/path`` and action of the longest rule that fits, else null."""
    name = action = None
    for h, p, a in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        action = F.when(fits, a) if action is None else action.when(fits, a)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, action)


def tokens(url: Column) -> Column:
    """Distinct tokens: ``h:`` host labels and the host itself, ``p:`` path words, ``q:`` query and fragment parts."""
    url = F.lower(F.coalesce(url, F.lit("")))
    host, path = split_url(url)
    rest = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(.*)$", 1)
    words = lambda text, by, mark: F.transform(
        F.filter(F.split(text, by), lambda w: w != ""), lambda w: F.concat(F.lit(mark), F.regexp_replace(w, "[0-9]+", "<num>")))
    return F.array_distinct(F.concat(words(host, r"\.", "h:"), F.filter(F.array(F.concat(F.lit("h:"), host)), lambda h: h != "h:"),
                                     words(path, r"[/._-]", "p:"), words(rest, "[?&#]", "q:")))


def mine(labelled: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """``(antecedent, confidence, support)`` of the kept rules for
    ``labelled(tokens, bad)``."""
    from pyspark.ml.fpm import FPGrowth

    spark = labelled.sparkSession
    baskets = saved(labelled.select(F.when(F.col("bad"), F.array_append("tokens", BAD)).otherwise(F.col("tokens")).alias("items"), "bad"), "url-baskets")
    total, bad = baskets.agg(F.count(F.lit(1)), F.count_if("bad")).first()
    empty = spark.range(0).select(F.array().cast("array<string>").alias("antecedent"), F.lit(0.0).alias("confidence"), F.lit(0.0).alias("support"))
    share = max(mining.support, mining.least / max(total, 1))
    if bad < max(1, share * total):
        return empty
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=mining.confidence).fit(baskets.select("items"))
    rules = saved(model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD)))
                  .select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support"), "url-rules")
    # prune rules that a rule with fewer of their tokens already gives: compare along shared tokens
    small = rules.select(F.col("antecedent").alias("part"), F.col("confidence").alias("c2"), F.element_at("antecedent", 1).alias("token"))
    large = rules.select("antecedent", "confidence", F.explode("antecedent").alias("token"))
    worse = (large.join(small, "token").where((F.size("part") < F.size("antecedent")) & (F.col("c2") >= F.col("confidence"))
                                              & (F.size(F.array_except("part", "antecedent")) == 0)).select("antecedent").distinct())
    return rules.join(worse, "antecedent", "left_anti")


def rule_index(rules: DataFrame, labelled: DataFrame) -> DataFrame:
    """``(token, antecedent)``: each rule under the token that the fewest labelled urls have."""
    seen = labelled.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    each = rules.select("antecedent", F.explode("antecedent").alias("token")).join(seen, "token")
    return each.groupBy("antecedent").agg(F.min(F.struct("n", "token")).alias("rare")).select(F.col("rare.token").alias("token"), "antecedent")


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, mining: Mining = Mining()) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages(page_id,
    url)``; ``labels(url, bad)`` are labelled urls to mine (null labels do not count)."""
    host, path = split_url(F.col("url"))
    name, action = longest_rule(F.col("host"), F.col("path"), rules)
    # uid names a row for the index join; it is fixed by writing the table
    rows = saved(pages.select("page_id", "url").select(F.monotonically_increasing_id().alias("uid"), "page_id", host.alias("host"), path.alias("path"),
                                                       tokens(F.col("url")).alias("tokens"))
                 .select("*", name.alias("rule"), action.alias("action")), "url-rows")
    labelled = saved(labels.where("url is not null and bad is not null").groupBy("url").agg(F.max("bad").alias("bad"))
                     .select(tokens(F.col("url")).alias("tokens"), "bad"), "url-labelled")
    index = saved(rule_index(mine(labelled, mining), labelled), "url-index")
    open_rows = rows.where("action is null").select("uid", "tokens", F.explode("tokens").alias("token"))
    blocked = (open_rows.join(index, "token").where(F.size(F.array_except("antecedent", "tokens")) == 0).groupBy("uid").agg(F.lit(True).alias("hit")))
    verdict = F.coalesce(F.col("action"), F.when(F.col("hit"), "block").otherwise("allow"))
    return rows.drop("tokens").join(blocked, "uid", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))


__all__ = ["RULES", "Mining", "split_url", "longest_rule", "tokens", "mine", "rule_index", "judge"]
