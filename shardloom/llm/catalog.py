"""Queries ``opN_<name>`` and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (byte_bpe, chat_rotation, embedding_dedup, mixing, quality_perplexity, secret_scan, simhash_dedup, substring_dedup, toxicity_fm,
               url_rules, vector_codes, warc, whitening)
from .common import read_table

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        LLM_QUERIES[name] = fn
        if sql is not None:
            LLM_ORACLE[name] = sql
        return fn
    return deco


_MIX = mixing.Mix(even=True)


@query("op2_mix_sources", f"""
WITH doc AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS w, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS pos FROM doc GROUP BY source),
wt AS (SELECT *, CASE pos % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM src),
fill AS (SELECT *, sum(2 * w) OVER o AS capped, sum(weight) OVER () - sum(weight) OVER o AS free, sum(w) OVER () AS total,
         2.0::DOUBLE * w / weight AS ratio FROM wt WINDOW o AS (ORDER BY 2.0::DOUBLE * w / weight, pos)),
-- the level: with the sources of the k smallest ratios at their cap, the rest share what is left; the largest k that holds
lev AS (SELECT coalesce(max(l), (SELECT 1.5::DOUBLE * sum(w) / sum(weight) FROM wt)) AS l
        FROM (SELECT (1.5::DOUBLE * total - capped) / free AS l, ratio FROM fill WHERE free > 0) WHERE l > ratio),
tgt AS (SELECT wt.*, least((2 * w)::DOUBLE, weight * (SELECT l FROM lev)) AS target FROM wt),
tot AS (SELECT sum(target) AS total, count(*) AS num, greatest(1, least({_MIX.most_block}, floor(min(target) / {_MIX.parts})))::BIGINT AS block
        FROM tgt WHERE target > 0),
hs AS (SELECT *, greatest(1, round_even(total / block, 0))::BIGINT AS house FROM tot),
part AS (SELECT tgt.pos, shard, target, ceil(w / block)::BIGINT AS n, floor(house * shard / {_MIX.shards})::BIGINT AS seats_all, target / total AS share, num / 2 AS half
         FROM tgt, hs, range(1, {_MIX.shards} + 1) t(shard) WHERE target > 0),
bnd AS (SELECT *, greatest(0, ceil(share * (seats_all - half) - 0.5) - 1)::BIGINT AS sure, (floor(share * (seats_all + half) + 0.5) + 1)::BIGINT AS most FROM part),
cand AS (SELECT shard, pos, row_number() OVER (PARTITION BY shard ORDER BY target / (2 * k + 1) DESC, pos) AS rk
         FROM (SELECT shard, pos, target, unnest(range(sure, most + 1)) AS k FROM bnd)),
won AS (SELECT shard, pos, count(*) AS more FROM cand JOIN (SELECT shard, max(seats_all) - sum(sure) AS free FROM bnd GROUP BY shard) USING (shard)
        WHERE rk <= free GROUP BY shard, pos),
quota AS (SELECT pos, n, list(least(sure + coalesce(more, 0), 2 * n)::BIGINT ORDER BY shard) AS upto FROM bnd LEFT JOIN won USING (shard, pos) GROUP BY pos, n),
line AS (SELECT tgt.source, tgt.w, tgt.target, greatest(coalesce(n, 1), 1) AS n, coalesce(upto, []) AS upto,
         coalesce(upto[-1], 0) // greatest(coalesce(n, 1), 1) AS whole, coalesce(upto[-1], 0) % greatest(coalesce(n, 1), 1) AS r,
         ('0x' || substr(md5('{_MIX.seed}:' || tgt.pos), 1, 12))::BIGINT % greatest(coalesce(n, 1), 1) AS c, coalesce((SELECT block FROM hs), 1) AS block
         FROM tgt LEFT JOIN quota USING (pos)),
spot AS (SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY coalesce((doc_id % {mixing.BINS} + {mixing.BINS}) % {mixing.BINS}, 0),
         doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING), 0)::BIGINT - size AS org FROM doc),
pick AS (SELECT s.doc_id, s.source, s.size, l.w, l.target, l.whole, l.upto, l.n, l.r::HUGEINT AS r, l.c, l.block, org, org // block AS k, (org + size) // block AS k2
         FROM spot s JOIN line l ON s.source IS NOT DISTINCT FROM l.source),
done AS (SELECT *, (k * r + c) // n AS a, ((k + 1) * r + c) // n AS a1, (k2 * r + c) // n AS b, ((k2 + 1) * r + c) // n AS b1 FROM pick),
res AS (SELECT *, (whole * size + block * (b - a) + (org + size - k2 * block) * (b1 - b) - (org - k * block) * (a1 - a))::BIGINT AS taken FROM done)
SELECT doc_id, size, w AS source_size, target, taken,
  CASE WHEN taken > 0 THEN len(list_filter(upto, lambda u: u <= CASE WHEN whole > 0 THEN k ELSE a END))::INTEGER ELSE -1 END AS shard FROM res""")
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    got = mixing.mix_plan(read_table(spark, sf_dir, "documents"), _MIX)
    return got.select("doc_id", "size", "source_size", "target", "taken", F.coalesce("shard", F.lit(-1)).alias("shard"))


@query("op3_simhash_dedup")
def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    got = simhash_dedup.simhash_groups(read_table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


_SPAN_SQL = ", ".join(f"({i}, '{r.kind}', $re${r.pattern}$re$, {r.least})" for i, r in enumerate(secret_scan.RULES))


@query("op8_secret_scan", rf"""
WITH rule(kind, name, pat, least) AS (VALUES {_SPAN_SQL}),
doc AS (SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS text FROM documents),
cut AS (SELECT uid, kind, name, least, pat, regexp_extract_all(text, pat) AS inside, string_split_regex(text, pat) AS around
        FROM doc, rule WHERE regexp_matches(text, pat)),
hit AS (SELECT uid, kind, name, least, pat, unnest(range(1, len(inside) + 1)) AS i, unnest(inside) AS m,
               unnest(around[1:len(inside)]) AS p FROM cut),
spot AS (SELECT *, sum(length(p) + length(m)) OVER (PARTITION BY uid, kind ORDER BY i) AS e FROM hit),
span AS (SELECT uid, kind, name, e - length(m) AS s, e FROM spot
         WHERE CASE WHEN least = 0 THEN TRUE ELSE length(regexp_extract(m, pat, 1)) >= least END),
told AS (SELECT uid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  coalesce(string_agg(concat(name, ':', s, ':', e), ',' ORDER BY s, kind) FILTER (kind < {secret_scan.BASE}), '') AS base,
  string_agg(concat(name, ':', s, ':', e), ',' ORDER BY s, kind) AS spans FROM span GROUP BY uid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM doc LEFT JOIN told USING (uid)""")
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the base kinds, all spans."""
    got = secret_scan.scan(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s.kind < secret_scan.BASE)
    count = lambda k: F.size(F.filter("spans", lambda s: s.kind == k)).cast("bigint")
    return got.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                      F.sha2(secret_scan.digest(base), 256).alias("base_sha256"), secret_scan.digest(F.col("spans")).alias("spans"))


def vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[bytes, str]:
    """Content of a public rank file, and the pattern that goes with it."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


@query("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes of every document."""
    return byte_bpe.encode(read_table(spark, sf_dir, "documents"), *vocabulary())


@query("op4_quality_perplexity")
def op4_quality_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    return quality_perplexity.judge(read_table(spark, sf_dir, "documents"))


@query("op9_warc", f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
o AS (SELECT page_id, h, CASE WHEN strlen(h) >= {warc.LEAST_REVISIT} THEN max(page_id) OVER (PARTITION BY h) END AS owner FROM p)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN owner IS NOT NULL AND page_id IS DISTINCT FROM owner THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM owner THEN owner END AS refers_to FROM o""")
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back from the archives."""
    got = warc.round_trip(read_table(spark, sf_dir, "pages"))
    return got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op5_url_rules")
def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url.  The last number in a page's path is the
    document it shows; that document's label is the url's."""
    pages, labels = read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels")
    shown = F.expr(r"try_cast(regexp_extract(url, '://[^?#]*/([0-9]{1,18})[^/0-9?#]*/?(?:[?#]|$)', 1) AS BIGINT)")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    told = pages.select("url", shown.alias("doc_id")).join(labels.select("doc_id", bad.alias("bad")), "doc_id")
    return url_rules.judge(pages, told.select("url", "bad"))


@query("op10_toxicity_fm")
def op10_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    training = toxicity_fm.Training()
    return toxicity_fm.score(docs, toxicity_fm.train(toxicity_fm.training_rows(docs, labels, training), training))


@query("op1_embedding_dedup")
def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate group of every vector."""
    return embedding_dedup.embedding_groups(read_table(spark, sf_dir, "embeddings"))


@query("op6_chat_rotation", f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS text,
           floor(turn / {chat_rotation.TURNS})::BIGINT AS part FROM conversations),
who AS (SELECT *, regexp_replace(replace(replace(role, '<|', '< |'), '#', '##'), '\\s', '_', 'g') AS shown FROM (SELECT DISTINCT conv_id, role FROM t)),
name AS (SELECT conv_id, role, concat(shown, CASE WHEN k > 1 THEN concat('#', k) ELSE '' END) AS speaker
         FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, shown ORDER BY role) AS k FROM who)),
r AS (SELECT t.*, speaker, row_number() OVER (PARTITION BY conv_id, part ORDER BY turn, role, text) - 1 AS rn FROM t JOIN name USING (conv_id, role)),
p AS (SELECT conv_id, speaker AS me FROM name WHERE role <> 'system'),
s AS (SELECT conv_id, part, rn // {chat_rotation.ROWS} AS piece, rn, me, speaker, concat('{chat_rotation.START}',
      CASE WHEN speaker = me THEN 'assistant' WHEN role = 'system' THEN 'system' ELSE concat('user name=', speaker) END, chr(10)) AS pre, text
      FROM r JOIN p USING (conv_id)),
g AS (SELECT *, concat(pre, text, '{chat_rotation.END}', chr(10)) AS seg FROM s),
o AS (SELECT *, sum(length(seg)) OVER (PARTITION BY conv_id, part, piece, me ORDER BY rn) - length(seg) AS org FROM g)
SELECT conv_id, part, piece::BIGINT AS piece, me AS perspective, count(*)::INTEGER AS n_turns, string_agg(seg, '' ORDER BY rn) AS text,
  coalesce(string_agg(concat(org + length(pre), ':', org + length(seg) - 1), ',' ORDER BY rn) FILTER (speaker = me), '') AS mask
FROM o GROUP BY conv_id, part, piece, me""")
def op6_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from every participant's perspective; the mask as ``start:end`` pairs."""
    got = chat_rotation.rotations(read_table(spark, sf_dir, "conversations"))
    return got.withColumn("mask", F.array_join(F.transform("mask", lambda m: F.concat_ws(":", m.start, m.end)), ","))


_CODING = vector_codes.Coding()


def _coding_sql(c: vector_codes.Coding) -> str:
    """The rounds one after the other, a component a row."""
    wide = "(SELECT max(len(embedding)) FROM vec)"
    steps = [f"""vec AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS uid, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
dim AS MATERIALIZED (SELECT uid, i - 1 AS i, floor({c.scale}::DOUBLE * embedding[i]::DOUBLE)::BIGINT AS x
  FROM (SELECT uid, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM vec)),
comp AS MATERIALIZED (SELECT uid, part, i, x FROM dim, (SELECT p AS part, p * {wide} // {c.parts} AS lo, (p + 1) * {wide} // {c.parts} AS hi
  FROM range({c.parts}) t(p)) WHERE i >= lo AND i < hi),
book0 AS MATERIALIZED (SELECT part, (uid - 1)::BIGINT AS entry, i, x AS c FROM comp WHERE uid <= {c.entries})"""]
    for t in range(c.rounds + 1):
        steps.append(f"""near{t} AS MATERIALIZED (SELECT uid, part, entry, d FROM (SELECT uid, part, entry, sum((x - c) * (x - c))::BIGINT AS d
  FROM comp JOIN book{t} USING (part, i) GROUP BY uid, part, entry) QUALIFY row_number() OVER (PARTITION BY uid, part ORDER BY d, entry) = 1)""")
        if t < c.rounds:
            steps.append(f"""book{t + 1} AS MATERIALIZED (SELECT part, entry, i, coalesce((s - ((s % n) + n) % n) // n, c)::BIGINT AS c FROM book{t} LEFT JOIN
  (SELECT part, entry, i, sum(x)::HUGEINT AS s, count(*) AS n FROM comp JOIN near{t} USING (uid, part) GROUP BY part, entry, i) USING (part, entry, i))""")
    last = c.rounds
    return "WITH " + ",\n".join(steps) + f""",
coded AS (SELECT uid, string_agg(printf('%02x', entry::INTEGER), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near{last} GROUP BY uid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, i)) FROM book{last}) AS codebooks_sha256 FROM vec JOIN coded USING (uid)"""


@query("op11_vector_codes", _coding_sql(_CODING))
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product code and errors of every vector."""
    return vector_codes.code_report(read_table(spark, sf_dir, "embeddings"), _CODING).drop("scans")


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first whitened components of every vector."""
    got = whitening.components(whitening.whiten(read_table(spark, sf_dir, "embeddings")))
    return got.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


_COVER = substring_dedup.Cover()


@query("op13_substring_dedup", rf"""
WITH doc AS MATERIALIZED (SELECT row_number() OVER () AS uid, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS MATERIALIZED (SELECT uid, doc_id, i, array_to_string(w[i:i + {_COVER.window - 1}], ' ') AS run
  FROM (SELECT uid, doc_id, w, unnest(range(1, len(w) - {_COVER.window - 2})) AS i FROM doc WHERE doc_id IS NOT NULL)),
hit AS (SELECT uid, i FROM win JOIN (SELECT run, min(doc_id) AS least FROM win GROUP BY run) USING (run) WHERE least < doc_id),
gone AS (SELECT DISTINCT uid, unnest(range(i, i + {_COVER.window})) AS i FROM hit),
word AS (SELECT uid, i, w[i] AS w FROM (SELECT uid, w, unnest(range(1, len(w) + 1)) AS i FROM doc)),
kept AS (SELECT uid, string_agg(w, ' ' ORDER BY i) AS t, count(*) AS n FROM word ANTI JOIN gone USING (uid, i) GROUP BY uid)
SELECT doc_id, len(doc.w)::BIGINT AS n_words, (len(doc.w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (uid)""")
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that smaller documents hold."""
    return substring_dedup.dedup(read_table(spark, sf_dir, "documents"), _COVER)
