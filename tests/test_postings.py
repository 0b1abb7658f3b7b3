"""Term counting inside a row against plain-Python counts."""

import random
from collections import Counter

from pyspark.sql import functions as F

from shardloom.operators import postings as po
from tests import rules


def _analyse(text):
    toks = rules.words(text.lower()) if text is not None else []
    return [t for t in toks if t and t not in po.STOP_WORDS]


ALPHABET = ["a", "b", "É", "z", "0", "7", ".", ",", ";", ":", "'", "\u2019", "_", " ", "-", "@", "中", "ひ",
            "カ", "タ", "ー", "\uff9e", "\u0301", "\n", "x1", "2.0",
            "\u00ad", "\u200d", "\u200b", "\ufeff", '"', "א", "ל"]


def test_tokens_equal_the_plain_word_rule(spark):
    rnd = random.Random(17)
    texts = sorted({"".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 25))) for _ in range(1500)})
    texts += ["hein.19@mail5.example.com 70.23.22.57 v2.0. 1,000 a.b.c don't _foo_ ___ end.Next",
              "カタカナabc abcカタ カ_a カ1 カ.a 中カ ひカ"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.k for r in df.select("t", po.tokens("t").alias("k")).collect()}
    for t in texts:
        assert got[t] == rules.words(t.lower()), t


FORMAT = {
    "co\u00adoperate a\u200db 1\u00ad,\u00ad000": ["co\u00adoperate", "a\u200db", "1\u00ad,\u00ad000"],
    "e\u0301\u00ad.x v\u00ad.1 1\u0301.b": ["e\u0301\u00ad.x", "v\u00ad", "1", "1\u0301", "b"],
    "zero\u200bwidth \u00adlead trail\u00ad": ["zero", "width", "lead", "trail\u00ad"],
    'צה"ל ג\' ג\'_ ג\'1 ג\'ד "צה" x"y': ['צה"ל', "ג'", "ג'", "ג'", "1", "ג'ד", "צה", "x", "y"],
    "中\u0301国 カ\u3099カ_a": ["中\u0301", "国", "カ\u3099カ_a"],
}


def test_format_characters_and_hebrew_quotes(spark):
    """Ignored characters part no word, and stay in it."""
    import duckdb

    from shardloom.plans.oracle import tokens_sql

    df = spark.createDataFrame([(t,) for t in FORMAT], "t string")
    got = {r.t: r.k for r in df.select("t", po.tokens("t").alias("k")).collect()}
    assert got == FORMAT == {t: rules.words(t.lower()) for t in FORMAT}
    con = duckdb.connect()
    assert {t: con.execute(f"SELECT {tokens_sql('t')} FROM (SELECT ? AS t)", [t]).fetchone()[0] for t in FORMAT} == FORMAT


def test_the_three_statements_of_the_classes_agree():
    from shardloom.plans import oracle as O

    points = lambda s: sorted(map(ord, s))
    assert points(po.MID_LETTER + po.MID_NUM_LET + po.SINGLE_QUOTE) == sorted((*O._MID_LETTER, *O._MID_NUM_LET, O._APOSTROPHE)) == points(rules.JOIN_LETTERS)
    assert points(po.MID_NUM + po.MID_NUM_LET + po.SINGLE_QUOTE) == sorted((*O._MID_NUM, *O._MID_NUM_LET, O._APOSTROPHE)) == points(rules.JOIN_DIGITS)
    assert points(po.EXTEND_NUM_LET) == sorted(O._UNDERSCORES) == points(rules.UNDERSCORES)
    assert points(po.KATAKANA_EXTRA) == sorted(O._KATAKANA_MARKS) == points(rules.KATAKANA_MARKS)


def test_count_terms_random_arrays(spark):
    rnd = random.Random(3)
    words = ["a", "b", "c", "zz", "é", "中文", "b "]
    rows = [(i, [rnd.choice(words) for _ in range(rnd.randint(0, 40))]) for i in range(300)]
    rows += [(1000, None), (1001, []), (1002, ["x"]), (1003, ["y"] * 50)]
    df = spark.createDataFrame(rows, "k int, arr array<string>")
    got = {}
    for r in po.count_terms(df, ["k"], F.col("arr")).collect():
        assert (r.k, r.term) not in got
        got[(r.k, r.term)] = r.tf
    want = {(k, t): c for k, arr in rows for t, c in Counter(arr or []).items()}
    assert got == want


def test_text_postings_equal_plain_counts(spark):
    texts = ["The cat and the hat", "", "x" * 300 + " short", "Zoë's café, café; CAFÉ 42 42",
             "a an the", "line\nbreak\ttab", None]
    df = spark.createDataFrame([(f"id{i}", t) for i, t in enumerate(texts)], "_id string, body string")
    recs = df.select(F.lit("ix").alias("_index"), F.lit(0).alias("_shard"), F.lit("t").alias("_type"),
                     "_id", F.col("body").alias("text"))
    from shardloom.plans.catalog import DOCS
    tspec = DOCS.types[0]
    got = {(r._id, r.term): r.tf for r in po.text_postings(recs, tspec).collect()}
    want = {(f"id{i}", term): c for i, t in enumerate(texts) for term, c in Counter(_analyse(t)).items()}
    assert got == want


def test_ascii_tokens_are_those_of_the_full_pattern(spark):
    import random
    rng = random.Random(5)
    rows = [("".join(rng.choice("aZ1_.:,;'\" -\t9\x00") for _ in range(rng.randint(0, 30))),) for _ in range(3000)]
    df = spark.createDataFrame([*rows, ("",), (None,), ("café a.b 1,0",)], "text string")
    full = F.regexp_extract_all(F.lower("text"), F.lit(po.TOKEN_PATTERN), 0)
    assert po.ASCII_TOKEN_PATTERN != po.TOKEN_PATTERN
    assert df.where(~po.tokens("text").eqNullSafe(full)).count() == 0


def test_postings_are_made_from_small_splits(spark, scratch):
    """Documents of one file become postings in several tasks, each of a few MB of it."""
    import glob

    from shardloom.plans.build import build_index
    from shardloom.sources import fixtures as fx
    words = F.concat_ws(" ", *[F.sha2(F.concat("id", F.lit(f"-{k}")), 256) for k in range(16)])
    lines = spark.range(0, 40_000, numPartitions=4).select(F.col("id").cast("string").alias("id")) \
        .select(F.concat_ws(",", "id", F.lit("en"), F.lit("s"), words).alias("value"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    res = build_index(spark, fx.docs_spec(1), scratch, inputs={"doc": lines}, postings=True)
    assert len(glob.glob(f"{scratch}/postings/*/*/part-*.parquet")) > len(glob.glob(f"{scratch}/documents/*/*/part-*.parquet"))
    assert res.postings.count() == 40_000 * 19 and spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_ascii_tokens_are_those_of_the_full_pattern(spark):
    import random
    rng = random.Random(5)
    rows = [("".join(rng.choice("aZ1_.:,;'\" -\t9\x00") for _ in range(rng.randint(0, 30))),) for _ in range(3000)]
    df = spark.createDataFrame([*rows, ("",), (None,), ("café a.b 1,0",)], "text string")
    full = F.regexp_extract_all(F.lower("text"), F.lit(po.TOKEN_PATTERN), 0)
    assert po.ASCII_TOKEN_PATTERN != po.TOKEN_PATTERN
    assert df.where(~po.tokens("text").eqNullSafe(full)).count() == 0
