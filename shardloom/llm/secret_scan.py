"""Secret scan over a trigram inverted index, in DataFrame functions only.

1. Each rule's pattern is turned into a Boolean trigram query: a text that
   matches contains, for at least one alternative, all its trigrams
   (case-folded).  A pattern without mandatory trigrams has no query.
2. The index holds a posting (trigram, document) for every trigram that some
   query asks for; it covers every document and is written to the shared
   scratch folder.
3. Queries are joined to the postings; a document that has all trigrams of an
   alternative is a candidate of the rule.
4. Candidates are verified by the pattern over the whole text; rules without
   a query scan all documents.  ``split`` and ``regexp_extract_all`` give the
   text around and inside the matches, a running sum of their lengths the
   positions (code points, end exclusive).

Matches of one kind are leftmost and do not overlap; kinds may overlap each
other.  Defined results: a null or empty text has no span; a text of any length is searched whole; a row without
``doc_id`` cannot be found through the index, so it is scanned by every rule;
rows that share a ``doc_id`` are candidates together and verified one by one;
an empty table gives no rows; extra columns are ignored by ``scan`` and kept
by ``redact``.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _constants as C
from re import _parser

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.parse import compute_once
from .common import saved


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int = 0          # least length of group 1, where the pattern has one


# The three base kinds, then formats that issuers publish for
# their credentials.  ``[0-9a-f]{16,}`` finds what ``[0-9a-f]+`` with 16 or more
# characters finds, and likewise for access keys: a shorter run has no match inside.
RULES = (
    Rule("assign", "(?:" + "|".join(map(_either_case, ("password", "passwd", "secret", "token")))
         + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]" + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12),
    Rule("access", "AKIA[A-Z0-9]{14,}"),
    Rule("hex", "[0-9a-f]{16,}"),
    Rule("github", "gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", "[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}"),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("login", r"://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/:@]+@"),
)
BASE = 3
MOST_ALTERNATIVES = 64     # beyond it a part of a pattern asks for no trigram (a looser query, same results)


# --- trigram queries ---------------------------------------------------------

def _strings(item) -> set[str] | None:
    """All case-folded strings one parsed item can match, if they are few."""
    op, arg = item
    if op is C.LITERAL:
        return {chr(arg).lower()}
    if op is C.IN and arg[0][0] is not C.NEGATE:
        out = set()
        for o, a in arg:
            if o is C.LITERAL:
                out.add(chr(a).lower())
            elif o is C.RANGE and a[1] - a[0] < MOST_ALTERNATIVES:
                out |= {chr(x).lower() for x in range(a[0], a[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op is C.SUBPATTERN:
        return _sequence(arg[-1])
    if op is C.BRANCH:
        parts = [_sequence(x) for x in arg[1]]
        return None if None in parts else set().union(*parts)
    if op is C.MAX_REPEAT:
        low, high, what = arg
        one = _sequence(what)
        if one is not None and high <= 1:
            return one | {""} if low == 0 else one
    return None


def _sequence(items) -> set[str] | None:
    got = {""}
    for item in items:
        more = _strings(item)
        if more is None or len(got) * len(more) > MOST_ALTERNATIVES:
            return None
        got = {a + b for a, b in product(got, more)}
    return got


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives, each a set of trigrams that a match under it contains; an
    empty list if the pattern has no mandatory trigram."""
    found: list[frozenset[str]] = [frozenset()]

    def require(strings: set[str]) -> None:
        nonlocal found
        sets = {_trigrams(s) for s in strings}
        if frozenset() in sets or len(found) * len(sets) > MOST_ALTERNATIVES:
            return
        found = list(dict.fromkeys(a | b for a, b in product(found, sorted(sets, key=sorted))))

    def walk(items) -> None:
        run = {""}
        for item in items:
            more = _strings(item)
            if more is not None and len(run) * len(more) <= MOST_ALTERNATIVES:
                run = {a + b for a, b in product(run, more)}
                continue
            require(run)
            run = more if more is not None else {""}
            op, arg = item
            if more is None and op is C.SUBPATTERN:
                walk(arg[-1])
            elif more is None and op is C.MAX_REPEAT and arg[0] > 0:
                walk(arg[2])
        require(run)

    walk(_parser.parse(pattern))
    return [] if frozenset() in found else [a for a in found if not any(b < a for b in found)]


def _query_table(spark: SparkSession, rules: tuple[Rule, ...]) -> tuple[DataFrame, list[str], set[int]]:
    """Rows ``(rule, alt, need, tri)``, the trigrams asked for, and the rules without a query."""
    rows, full = [], set()
    for r, rule in enumerate(rules):
        query = trigram_query(rule.pattern)
        if not query:
            full.add(r)
        rows += [(r, a, len(alt), t) for a, alt in enumerate(query) for t in sorted(alt)]
    grams = sorted({t for *_, t in rows})
    made = spark.range(1).select(F.explode(F.array(
        F.struct(F.lit(-1).alias("rule"), F.lit(0).alias("alt"), F.lit(0).alias("need"), F.lit("").alias("tri")),
        *[F.struct(F.lit(r).alias("rule"), F.lit(a).alias("alt"), F.lit(n).alias("need"), F.lit(t).alias("tri"))
          for r, a, n, t in rows])).alias("q")).select("q.*")
    return made, grams, full


# --- index, candidates, verification -------------------------------------------

def trigram_index(docs: DataFrame, grams: list[str]) -> DataFrame:
    """Postings ``(tri, doc_id)`` of the given trigrams in the case-folded text."""
    asked = F.array(*[F.lit(g) for g in grams])
    # the folded text is bound to a lambda variable, so it is made once a row, not once a trigram
    found = F.flatten(F.transform(F.array(F.lower("text")), lambda low: F.filter(asked, lambda g: F.contains(low, g))))
    rows = docs.where("doc_id is not null and text is not null")
    # explode_outer: plain explode makes the optimizer test the array's size first, which computes it twice
    return rows.select("doc_id", F.explode_outer(found).alias("tri")).where("tri is not null")


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, set[int]]:
    """``(doc_id, rules)`` of the documents some query admits, and the rules that scan all."""
    queries, grams, full = _query_table(docs.sparkSession, rules)
    index = saved(trigram_index(docs, grams), "secret-index")
    met = (index.join(F.broadcast(queries), "tri")               # bounded by the rule set
           .groupBy("doc_id", "rule", "alt", "need").agg(F.count_distinct("tri").alias("n")).where("n = need"))
    return met.groupBy("doc_id").agg(F.collect_set("rule").alias("rules")), full


def _counts(match: Column, rule: Rule) -> Column:
    """Whether a match is long enough to be reported."""
    return F.length(F.regexp_extract(match, rule.pattern, 1)) >= rule.least if rule.least else F.lit(True)


def _matches(text: Column, rule: Rule, r: int) -> Column:
    """Per match: kind, order, length of the text before it, its length, whether it counts."""
    around = F.split(text, rule.pattern, -1)
    inside = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    both = F.zip_with(around, inside, lambda p, m: F.struct(
        F.lit(r).alias("kind"), F.length(p).alias("p"), F.length(m).alias("m"), F.coalesce(_counts(m, rule), F.lit(False)).alias("ok")))
    return F.filter(both, lambda x: x.m.isNotNull())


def _without(text: Column, rule: Rule) -> Column:
    """The text before each match, then the kind, or the match itself where it does not count."""
    around = F.split(text, rule.pattern, -1)
    inside = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    return F.array_join(F.zip_with(around, inside, lambda p, m: F.concat(
        p, F.when(m.isNull(), "").when(_counts(m, rule), f"[{rule.kind}]").otherwise(m))), "")


_HITS = "array<struct<kind:int,p:int,m:int,ok:boolean>>"


def _admitted(r: int, full: set[int]) -> Column:
    if r in full:
        return F.lit(True)
    return F.coalesce(F.array_contains("__llm_rules", r), F.lit(False)) | F.col("doc_id").isNull()


def _with_candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> tuple[DataFrame, set[int]]:
    cand, full = candidates(docs.select("doc_id", "text"), rules)
    return docs.join(cand.withColumnRenamed("rules", "__llm_rules"), "doc_id", "left"), full


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: ``doc_id`` and ``spans``, an array of ``(start,
    kind, end)`` in that order; ``kind`` is the rule's number."""
    told, full = _with_candidates(docs.select("doc_id", "text"), rules)
    text, none = F.col("text"), F.array().cast(_HITS)
    hits = F.concat(*[F.when(_admitted(r, full) & text.rlike(rule.pattern), _matches(text, rule, r)).otherwise(none)
                      for r, rule in enumerate(rules)])
    # uid names a row for the steps below; it is fixed by writing the table
    done = saved(told.select(F.monotonically_increasing_id().alias("uid"), "doc_id", hits.alias("hits")), "secret-hits")
    each = done.select("uid", F.posexplode("hits").alias("i", "hit")).select("uid", "i", "hit.*")
    upto = F.sum(F.col("p") + F.col("m")).over(Window.partitionBy("uid", "kind").orderBy("i"))
    spans = (each.withColumn("end", upto.cast("int")).where("ok")
             .groupBy("uid").agg(F.array_sort(F.collect_list(F.struct((F.col("end") - F.col("m")).alias("start"), "kind", "end"))).alias("spans")))
    return (done.select("uid", "doc_id").join(spans, "uid", "left")
            .select("doc_id", F.coalesce("spans", F.array().cast("array<struct<start:int,kind:int,end:int>>")).alias("spans")))


def digest(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    names = F.array(*[F.lit(x.kind) for x in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start, s.end)), ",")


def _marks(text: Column, rule: Rule, r: int) -> Column:
    """For every character ``r + 1`` inside a match that counts, else 0."""
    around = F.split(text, rule.pattern, -1)
    inside = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    mark = lambda m: F.when(_counts(m, rule), r + 1).otherwise(0)
    return F.flatten(F.zip_with(around, inside, lambda p, m: F.concat(
        F.array_repeat(F.lit(0), F.length(p)), F.coalesce(F.array_repeat(mark(m), F.length(m)), F.array().cast("array<int>")))))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the union of the spans that ``scan`` finds replaced, and ``n_chars``
    (if there) counted anew where the text changed.

    Every rule is matched against the text as it came.  A run of characters that one or
    more matches cover becomes ``[kind]``, of the first rule that covers its first
    character; so a secret that several rules see in part goes whole.
    """
    cols = docs.columns
    told, full = _with_candidates(docs, rules)
    text = F.col("text")
    found = F.filter(F.array(*[F.when(_admitted(r, full) & text.rlike(rule.pattern), F.lit(r)) for r, rule in enumerate(rules)]), lambda r: r.isNotNull())
    told = compute_once(told.select(*cols, found.alias("__llm_found")))
    # one rule: the text between its matches; several (few documents): marks of all of them, character by character
    one = F.coalesce(*[F.when(F.get("__llm_found", F.lit(0)) == r, _without(text, rule)) for r, rule in enumerate(rules)])
    none = F.array_repeat(F.lit(0), F.length(text))
    marks = F.lit(None).cast("array<int>")
    for r, rule in enumerate(rules):
        seen = F.when(F.array_contains("__llm_found", r), _marks(text, rule, r)).otherwise(none)
        marks = seen if r == 0 else F.zip_with(marks, seen, lambda a, b: F.when(a == 0, b).otherwise(a))
    several = F.size("__llm_found") > 1
    told = compute_once(told.withColumns({"__llm_marks": F.when(several, marks),
                                          "__llm_chars": F.when(several, F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)))}))
    names = F.array(F.lit(""), *[F.lit(f"[{rule.kind}]") for rule in rules])
    pieces = F.transform("__llm_marks", lambda m, i: F.when(m == 0, F.get("__llm_chars", i)).when(
        (i == 0) | (F.get("__llm_marks", i - 1) == 0), F.get(names, m)).otherwise(""))
    size = F.size("__llm_found")
    clean = F.when(size > 1, F.array_join(pieces, "")).when(size == 1, one).otherwise(text)
    told = compute_once(told.select(*cols, clean.alias("__llm_text")))
    changed = ~F.col("__llm_text").eqNullSafe(text)
    out = {"text": F.col("__llm_text")}
    if "n_chars" in cols:
        out["n_chars"] = F.when(changed, F.length("__llm_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return told.select(*[out.get(c, F.col(c)).alias(c) for c in cols])


__all__ = ["Rule", "RULES", "BASE", "trigram_query", "trigram_index", "candidates", "scan", "digest", "redact"]
