"""Postings: the content of an inverted index, kept as rows.

* L2 keyword postings - the exact value of each non-null ``not_analyzed``
  field: one row per (document, field); a narrow projection, no shuffle.
* L3 text postings - fields mapped ``analyzed``: lower-cased words by the
  Unicode word-boundary rules (letters, digits and their joiners), English
  stop words dropped (a parameter; so is ``max_token_length``, by default
  none: every token is kept), term frequency per document.  All tokens of a document field are in one row, so the
  frequencies are counted inside that row (sort the tokens, measure the runs
  of equal ones): no exchange, and a frequent term is never gathered anywhere.
* L4 term dictionary - document and total frequency per (index, field, term),
  a partial + final aggregate (a hot term is one row per task before the
  exchange).

Postings stay rows: a common term never becomes one huge array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import DATA_TYPES, NUMBER_TYPES, TypeSpec
from .parse import compute_once

# The English stop-word set of the standard analyzer.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it",
    "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these",
    "they", "this", "to", "was", "will", "with",
)

# Word-boundary classes of the standard tokenizer (Unicode text
# segmentation, word boundaries, Unicode 6.3), as code points.  A MidLetter
# character joins two letters, a MidNum character two digits, MidNumLet and
# the single quote either; ExtendNumLet (the underscore family) joins anything.
MID_LETTER = "\u003A\u00B7\u0387\u05F4\u2027\uFE13\uFE55\uFF1A"
MID_NUM_LET = "\u002E\u2018\u2019\u2024\uFE52\uFF07\uFF0E"
MID_NUM = "\u002C\u003B\u037E\u0589\u060C\u060D\u066C\u07F8\u2044\uFE10\uFE14\uFE50\uFE54\uFF0C\uFF1B"
SINGLE_QUOTE = "\u0027"
DOUBLE_QUOTE = "\u0022"
EXTEND_NUM_LET = "\u005F\u203F\u2040\u2054\uFE33\uFE34\uFE4D\uFE4E\uFE4F\uFF3F"


def char_class(chars: str) -> str:
    """A regex character class of the given characters, as ``\\x{...}`` escapes."""
    return "[" + "".join(f"\\x{{{ord(c):X}}}" for c in chars) + "]"


JOIN_LETTERS = char_class(MID_LETTER + MID_NUM_LET + SINGLE_QUOTE)
JOIN_DIGITS = char_class(MID_NUM + MID_NUM_LET + SINGLE_QUOTE)
EXTEND = char_class(EXTEND_NUM_LET)
# Characters outside the Katakana script that count as Katakana
# for word boundaries (repeat, voiced and prolonged sound marks).
KATAKANA_EXTRA = "\u3031\u3032\u3033\u3034\u3035\u309B\u309C\u30A0\u30FC\uFF70\uFF9E\uFF9F"
# Han, Hiragana and Katakana all lie at U+2E80 and above: every script test
# is guarded by that range, so the common scripts never pay for it.
_HIGH = r"\x{2E80}-\x{10FFFF}"
_KATA = rf"[{_HIGH}&&[\p{{IsKatakana}}" + char_class(KATAKANA_EXTRA)[1:-1] + "]]"
_OWN_SCRIPTS = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}" + char_class(KATAKANA_EXTRA)[1:-1]
# Java regex of one token.  Marks and format characters (the zero width space
# aside) belong to the character before them and are ignored by the rules, so
# every character below may be followed by some.  A token is a word of letters
# and digits (scripts other than Han, Hiragana and Katakana) with its joiners,
# or a run of Katakana, words and runs meeting only through underscores; or one
# Han or Hiragana character.  After a Hebrew letter a single quote stays (an
# abbreviation), and a double quote does between two.  Lower-case ASCII is
# tried first, and the loops are possessive (nothing that follows them could
# use what they took, so the matches are the same).
_IGNORED = r"[\p{M}\p{Cf}&&[^\x{200B}]]"
_BACK = _IGNORED + "{0,32}"               # a look-behind must be bounded
_LETTER = rf"(?:[\p{{L}}&&[^{_HIGH}]]|[\p{{L}}&&[{_HIGH}]&&[^{_OWN_SCRIPTS}]])"
_ALNUM = rf"(?:[\p{{L}}\p{{N}}&&[^{_HIGH}]]|[\p{{L}}\p{{N}}&&[{_HIGH}]&&[^{_OWN_SCRIPTS}]])"
_HEBREW = r"[\p{IsHebrew}&&\p{L}]"
_JOINED = (
    rf"(?={char_class(MID_LETTER + MID_NUM_LET + MID_NUM + SINGLE_QUOTE + DOUBLE_QUOTE)})"
    rf"(?:(?<={_LETTER}{_BACK}){JOIN_LETTERS}(?={_IGNORED}*+{_LETTER})"
    rf"|(?<=\p{{Nd}}{_BACK}){JOIN_DIGITS}(?={_IGNORED}*+\p{{Nd}})"
    rf"|(?<={_HEBREW}{_BACK}){char_class(DOUBLE_QUOTE)}(?={_IGNORED}*+{_HEBREW}))"
)
_WORD = rf"(?:[a-z0-9]|{_ALNUM})(?:[a-z0-9]++|{_ALNUM}|{_IGNORED}|{_JOINED})*+"
_PART = rf"(?:{_WORD}|{_KATA}(?:{_KATA}|{_IGNORED})*+)"
_UNDER = rf"(?:{EXTEND}{_IGNORED}*+)"
TOKEN_PATTERN = (
    rf"{_UNDER}*+{_PART}(?:{_UNDER}++{_PART})*+"
    rf"(?:{_UNDER}++|(?<={_HEBREW}{_BACK}){char_class(SINGLE_QUOTE)}{_IGNORED}*+)?+"
    rf"|[{_HIGH}&&[\p{{IsHan}}\p{{IsHiragana}}]]{_IGNORED}*+"
)

# The same tokens for lower-case ASCII text, where marks, format characters and
# the other scripts do not occur.
_ASCII_WORD = "".join((
    "[a-z0-9](?:[a-z0-9]++",
    "|(?<=[a-z])" + char_class([c for c in MID_LETTER + MID_NUM_LET + SINGLE_QUOTE if c < "\x80"]) + "(?=[a-z])",
    "|(?<=[0-9])" + char_class([c for c in MID_NUM + MID_NUM_LET + SINGLE_QUOTE if c < "\x80"]) + "(?=[0-9]))*+"))
ASCII_TOKEN_PATTERN = f"_*+{_ASCII_WORD}(?:_++{_ASCII_WORD})*+_*+"


def keyword_fields(tspec: TypeSpec) -> list[str]:
    explicit = tspec.field_mapping()
    return [f for f in tspec.field_names
            if (explicit[f].index_mode if f in explicit else "not_analyzed") == "not_analyzed"]


def text_fields(tspec: TypeSpec) -> list[str]:
    explicit = tspec.field_mapping()
    return [f for f in tspec.field_names if f in explicit and explicit[f].index_mode == "analyzed"]


def canonical(value: F.Column, data_type: str) -> F.Column:
    """The term of an exact value: a number's own text (``7`` for ``007`` and
    ``+7``), any other value as it is.  A value that is no number stays."""
    if data_type not in NUMBER_TYPES:
        return value
    return F.coalesce(value.try_cast(DATA_TYPES[data_type]).cast("string"), value)


def keyword_postings(recs: DataFrame, tspec: TypeSpec) -> DataFrame:
    fields = keyword_fields(tspec)
    if not fields:
        return recs.sparkSession.createDataFrame(
            [], "index string, shard int, type string, field string, term string, _id string")
    explicit = tspec.field_mapping()
    terms = [canonical(F.col(f), explicit[f].data_type if f in explicit else "string").alias(f) for f in fields]
    keys = ["_index", "_shard", "_type", "_id"]
    long = recs.select(*keys, *terms).unpivot(keys, fields, "field", "term")
    return (long.filter(F.col("term").isNotNull())
            .select(F.col("_index").alias("index"), F.col("_shard").alias("shard"),
                    F.col("_type").alias("type"), "field", "term", "_id"))


def tokens(text) -> F.Column:
    """Analysed tokens of a text column, as an array (stop words kept): the
    lower-cased text's words by the word-boundary rules above, so
    ``example.com``, ``2.0``, ``10.0.0.1``, ``1,000``, ``don't`` and
    ``foo_bar`` are one token each, also with soft hyphens or other format
    characters inside (which stay in the token), a Katakana run is its own
    token, and each Han or Hiragana character is one."""
    text = F.col(text) if isinstance(text, str) else text
    # ASCII text takes a shorter pattern with the same matches
    plain = F.octet_length(text) == F.char_length(text)
    return (F.when(plain, F.regexp_extract_all(F.lower(text), F.lit(ASCII_TOKEN_PATTERN), 0))
            .otherwise(F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)))


def keep_token(t: F.Column, stop_words: tuple[str, ...] | None = STOP_WORDS, max_token_length: int | None = None) -> F.Column:
    """A token becomes a term when it is not empty, not a stop word and, with
    ``max_token_length``, not longer than that."""
    k = t != ""
    if max_token_length is not None:
        k = k & (F.length(t) <= max_token_length)
    return k & ~t.isin(*stop_words) if stop_words else k


def count_terms(df: DataFrame, keys: list[str], terms: F.Column, keep=None) -> DataFrame:
    """``(*keys, term, tf)``: one row per distinct element of each row's
    ``terms`` array, with its number of occurrences in that array; with
    ``keep`` (a function of the term column), only the terms it accepts.

    The count stays inside the row, so there is no exchange: the array is
    sorted (JVM sort), the start of every run of equal terms is marked, and
    run lengths are the frequencies.  ``keep`` is applied to the distinct
    terms, not to every token.  Each step is materialised once before the
    next one's lambda reads it (a lambda would otherwise re-evaluate the sort
    for every element it visits).
    """
    n = F.size("_terms")
    st = F.col("_starts")
    m = F.size(st)
    sorted_ = compute_once(df.select(*keys, F.sort_array(terms).alias("_terms")))
    runs = compute_once(sorted_.select(*keys, "_terms", F.when(n > 0, F.filter(
        F.sequence(F.lit(1), n),
        lambda i: (i == 1) | (F.element_at("_terms", i) != F.element_at("_terms", i - 1)))).alias("_starts")))
    pairs = F.when(n > 0, F.transform(F.sequence(F.lit(1), m), lambda j: F.struct(
        F.element_at("_terms", F.element_at(st, j)).alias("term"),
        (F.when(j < m, F.element_at(st, j + 1)).otherwise(n + 1) - F.element_at(st, j)).cast("bigint").alias("tf"))))
    if keep is not None:
        pairs = F.filter(pairs, lambda p: keep(p["term"]))
    return runs.select(*keys, F.inline(pairs))


def text_postings(recs: DataFrame, tspec: TypeSpec, stop_words: tuple[str, ...] | None = STOP_WORDS,
                  max_token_length: int | None = None) -> DataFrame:
    fields = text_fields(tspec)
    if not fields:
        return recs.sparkSession.createDataFrame(
            [], "index string, shard int, type string, field string, term string, _id string, tf bigint")
    long = recs.unpivot(["_index", "_shard", "_type", "_id"], fields, "field", "text")
    named = long.select(F.col("_index").alias("index"), F.col("_shard").alias("shard"),
                        F.col("_type").alias("type"), "field", "_id", "text")
    return count_terms(named, ["index", "shard", "type", "field", "_id"], tokens("text"),
                       keep=lambda t: keep_token(t, stop_words, max_token_length))


def term_stats(postings: DataFrame) -> DataFrame:
    """L4: ``(index, field, term, doc_freq, total_freq)``; ids are unique,
    so a posting row is one document and no distinct is needed."""
    tf = F.col("tf") if "tf" in postings.columns else F.lit(1)
    return postings.groupBy("index", "field", "term").agg(
        F.count(F.lit(1)).alias("doc_freq"), F.sum(tf).cast("bigint").alias("total_freq"))


def _field_modes(spark, ispec) -> DataFrame:
    """``(type, field, index_mode)`` for every declared field: spec-sized."""
    rows = []
    for t in ispec.types:
        explicit = t.field_mapping()
        for f in t.field_names:
            m = explicit.get(f)
            rows.append((t.name, f, m.index_mode if m else "not_analyzed", m.data_type if m else "string"))
    return spark.createDataFrame(rows, "type string, field string, index_mode string, data_type string")


def postings_from_documents(docs: DataFrame, ispec, stop_words: tuple[str, ...] | None = STOP_WORDS,
                            max_token_length: int | None = None) -> DataFrame:
    """L2 + L3 from the document table in one scan of it.

    Every document is parsed once with the union of the declared fields (all
    strings; a field of another type is simply absent), turned into
    ``(field, value)`` rows, and joined with the spec's field modes (a
    broadcast of a spec-sized table).  ``not_analyzed`` values are one term;
    ``analyzed`` values are tokenised; ``no`` fields are skipped.  Output:
    ``(index, shard, type, field, term, _id, tf)``.
    """
    spark = docs.sparkSession
    names: list[str] = []
    for t in ispec.types:
        names += [f for f in t.field_names if f not in names]
    schema = "struct<" + ",".join(f"`{n}`:string" for n in names) + ">"
    parsed = docs.select("index", "shard", "type", "_id", F.from_json("doc", schema).alias("_f"))
    kv = F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col("_f")[n].alias("value")) for n in names]))
    long = parsed.select("index", "shard", "type", "_id", kv.alias("_kv")) \
        .select("index", "shard", "type", "_id", "_kv.field", "_kv.value") \
        .filter(F.col("value").isNotNull())
    modes = F.broadcast(_field_modes(spark, ispec).filter(F.col("index_mode") != "no"))
    j = long.join(modes, ["type", "field"])
    analyzed = F.col("index_mode") == "analyzed"
    # a keyword value is one term of its document field (tf 1); an analysed
    # value's terms are counted inside its row (no exchange either way)
    exact = F.col("value")
    for data_type in NUMBER_TYPES:
        exact = F.when(F.col("data_type") == data_type, canonical(F.col("value"), data_type)).otherwise(exact)
    terms = F.when(analyzed, tokens("value")).otherwise(F.array(exact))
    out = count_terms(j.withColumn("_an", analyzed), ["index", "shard", "type", "field", "_id", "_an"], terms,
                      keep=lambda t: ~F.col("_an") | keep_token(t, stop_words, max_token_length))
    return out.drop("_an")
