"""Registered queries: one per operator of the build, each over the given tables.

Every query takes ``(spark, sf_dir)``, renders its feed from the parquet
tables with Spark, runs the operator and returns a DataFrame.  ``ORACLE``
holds the same result restated in DuckDB SQL (see ``oracle.py``); a query
without an entry is checked by row count and by tests.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as X
from ..operators import aggregates as agg
from ..operators import duplicates as du
from ..operators import grid as grd
from ..operators import lookup as lk
from ..operators import mapping as mp
from ..operators import parse as ps
from ..operators import postings as po
from ..session import scratch_path
from ..sinks import dictionary as dc
from ..sinks import documents as sk
from ..sources import fixtures as fx
from ..sources import lines as ln
from ..spec import FieldMapping, IndexSpec, TypeSpec
from . import oracle as O
from .build import build_index

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


EV = fx.events_spec(10)
EV64 = fx.events_spec(64)
ORD = fx.orders_spec(10)
UNI = fx.union_spec(10)
PARTS = fx.parts_spec(4)
DOCS = fx.docs_spec(8)


def _parsed(spark, sf, ispec: IndexSpec, tname: str | None = None):
    t = ispec.types[0] if tname is None else ispec.type(tname)
    return ps.parse_lines(fx.FEEDS[t.name](spark, sf), t, ispec)


def _records(spark, sf, ispec: IndexSpec, tname: str | None = None, mode="quarantine"):
    t = ispec.types[0] if tname is None else ispec.type(tname)
    return ps.records(_parsed(spark, sf, ispec, tname), t, mode=mode)


def _docs(spark, sf, ispec: IndexSpec, mode="quarantine"):
    d, _ = ps.parse_types(fx.feed_inputs(spark, sf, ispec), ispec, mode=mode)
    return d


EV_FIELDS = list(fx.EVENT_TYPE.field_names)
EV_DOCS_SQL = O.docs_sql(fx.EVENT_TYPE, EV)
EV_LINES_SQL = O.EVENTS_LINES
EV_PARSED_SQL = O.parsed_sql(fx.EVENT_TYPE, EV, O.EVENTS_LINES)


# --- sources ---------------------------------------------------------------

@query("scan_lines", f"""SELECT count(*) AS n_lines, CAST(sum(strlen(value)) AS BIGINT) AS n_bytes
FROM ({EV_LINES_SQL})""")
def scan_lines(spark, sf):
    """Write the feed with a custom record delimiter, gzip-compressed, and read it back."""
    path = scratch_path(spark, "scan-lines")
    ln.write_lines(fx.events_lines(spark, sf), path, line_sep=";", compression="gzip")
    back = ln.read_lines(spark, path, line_sep=";")
    return back.agg(F.count(F.lit(1)).alias("n_lines"),
                    F.sum(F.octet_length("value")).cast("bigint").alias("n_bytes"))


@query("scan_type_tag", f"""SELECT type, count(*) AS n_lines, CAST(sum(strlen(value)) AS BIGINT) AS n_bytes FROM (
SELECT 'event' AS type, value FROM ({O.EVENTS_LINES}) UNION ALL SELECT 'order' AS type, value FROM ({O.ORDERS_LINES}))
GROUP BY type""")
def scan_type_tag(spark, sf):
    """One shared scan over two type folders, tagged by path."""
    base = scratch_path(spark, "scan-typed")
    ln.write_lines(fx.events_lines(spark, sf), f"{base}/event")
    ln.write_lines(fx.orders_lines(spark, sf), f"{base}/order")
    tagged = ln.read_typed(spark, {"event": f"{base}/event", "order": f"{base}/order"})
    return tagged.groupBy("type").agg(F.count(F.lit(1)).alias("n_lines"),
                                      F.sum(F.octet_length("value")).cast("bigint").alias("n_bytes"))


MAX_LINE = 4096


@query("filter_long_lines", f"""SELECT count(*) AS n_lines, CAST(sum(strlen(value)) AS BIGINT) AS n_bytes,
  CAST(max(strlen(value)) AS INTEGER) AS max_bytes
FROM ({O.DOCS_LINES}) WHERE strlen(value) + 1 < {MAX_LINE}""")
def filter_long_lines(spark, sf):
    """S3: keep lines whose bytes plus delimiter are under the limit."""
    kept = ln.filter_long_lines(fx.docs_lines(spark, sf), MAX_LINE, "\n")
    return kept.agg(F.count(F.lit(1)).alias("n_lines"),
                    F.sum(F.octet_length("value")).cast("bigint").alias("n_bytes"),
                    F.max(F.octet_length("value")).alias("max_bytes"))


def _both_sql(ispec):
    ev, od = (O.docs_sql(t, ispec) for t in ispec.types)
    return f"""SELECT _index AS index, _shard AS shard, _type AS type, _id, uid AS routing, event_type AS text FROM ({ev})
UNION ALL SELECT _index AS index, _shard AS shard, _type AS type, _id, custkey AS routing, priority AS text FROM ({od})"""


def _both(docs):
    one = lambda a, b: F.coalesce(F.get_json_object("doc", f"$.{a}"), F.get_json_object("doc", f"$.{b}"))
    return docs.select("index", "shard", "type", "_id", one("uid", "custkey").alias("routing"), one("event_type", "priority").alias("text"))


@query("union_types", _both_sql(UNI))
def union_types(spark, sf):
    """Events and orders, each with its own separator and fields, in one index;
    ids and fields of both."""
    return _both(_docs(spark, sf, UNI))


@query("build_shared_scan", _both_sql(UNI))
def build_shared_scan(spark, sf):
    """S2 in the build: one scan over the folders of both types, dispatched line by line."""
    base = scratch_path(spark, "tree")
    for t in UNI.types:
        ln.write_lines(fx.FEEDS[t.name](spark, sf), f"{base}/{t.name}")
    ispec = replace(UNI, types=tuple(replace(t, input_path=f"{base}/{t.name}") for t in UNI.types))
    return _both(build_index(spark, ispec, scratch_path(spark, "shared"), mode="quarantine", created_at=CREATED_AT).documents)


# --- projections and filters -------------------------------------------------

@query("split_escaped", f"""SELECT value, CAST(pos - 1 AS INTEGER) AS pos, field FROM (
SELECT value, unnest(f) AS field, unnest(range(1, len(f) + 1)) AS pos FROM (
SELECT value, {O.split_sql('value', ',')} AS f FROM ({EV_LINES_SQL})))""")
def split_escaped(spark, sf):
    """P1."""
    return ps.split_fields(fx.events_lines(spark, sf), ",")


@query("arity_reject", f"""SELECT _type AS type, _line AS value, _reason AS reason FROM ({EV_PARSED_SQL}) WHERE _status = 'rejected'""")
def arity_reject(spark, sf):
    """P2 (quarantine mode)."""
    return ps.rejected(_parsed(spark, sf, EV))


@query("project_fields", f"""SELECT value, {', '.join(f'f[{i + 1}] AS {n}' for i, n in enumerate(EV_FIELDS))} FROM (
SELECT value, {O.split_sql('value', ',')} AS f FROM ({EV_LINES_SQL})) WHERE len(f) = 6 AND value <> ''""")
def project_fields(spark, sf):
    """P3."""
    return ps.project_fields(fx.events_lines(spark, sf), fx.EVENT_TYPE)


@query("null_tokens", f"""SELECT value, {', '.join(f'{O.null_token_sql(f"f[{i + 1}]")} AS {n}' for i, n in enumerate(EV_FIELDS))} FROM (
SELECT value, {O.split_sql('value', ',')} AS f FROM ({EV_LINES_SQL})) WHERE len(f) = 6 AND value <> ''""")
def null_tokens(spark, sf):
    """P4."""
    raw = ps.project_fields(fx.events_lines(spark, sf), fx.EVENT_TYPE)
    return raw.select("value", *[X.null_token(n).alias(n) for n in EV_FIELDS])


@query("unescape_fields", f"""SELECT doc_id, lang, source, text FROM ({O.docs_sql(fx.DOC_TYPE, DOCS)})""")
def unescape_fields(spark, sf):
    """P5 on whole document texts: escape, split and unescape give the text back."""
    return _records(spark, sf, DOCS).select("doc_id", "lang", "source", "text")


@query("filter_routing", f"""SELECT value FROM ({EV_LINES_SQL}) WHERE value = '' OR
  NOT (len({O.split_sql('value', ',')}) > 3 AND {O.split_sql('value', ',')}[4] IN ('', '\\N'))""")
def filter_routing(spark, sf):
    """Lines left after dropping an empty or ``\\N`` routing key."""
    return _parsed(spark, sf, EV).filter(F.col("_status") != ps.DROPPED).select(F.col("_line").alias("value"))


@query("build_documents", f"""SELECT _index AS index, _shard AS shard, _type AS type, {', '.join(EV_FIELDS)} FROM ({EV_DOCS_SQL})""")
def build_documents(spark, sf):
    """The document text, read back field by field."""
    d = ps.documents(_parsed(spark, sf, EV), fx.EVENT_TYPE, EV, mode="quarantine")
    return d.select("index", "shard", "type",
                    *[F.get_json_object("doc", f"$.{n}").alias(n) for n in EV_FIELDS])


@query("document_ids", f"""SELECT _line AS value, _id FROM ({EV_DOCS_SQL})""")
def document_ids(spark, sf):
    """P8 (key mode): the id is a hash of the declared unique key."""
    return _parsed(spark, sf, EV).filter(F.col("_status") == ps.OK).select(F.col("_line").alias("value"), "_id")


# Lines without a key: a few distinct ones, each many times.
LINE_TYPE = TypeSpec("line", ("flag", "status", "year"), field_sep="|", routing_field="year")
LINES = IndexSpec("lines", 6, (LINE_TYPE,))
_LINE_LINES = "SELECT concat_ws('|', l_returnflag, l_linestatus, CAST(year(l_shipdate) AS VARCHAR)) AS value FROM lineitem"


def _line_lines(spark, sf):
    return fx.table(spark, sf, "lineitem").select(F.concat_ws("|", "l_returnflag", "l_linestatus", F.year("l_shipdate").cast("string")).alias("value"))


@query("document_ids_content", f"""SELECT value, {O.hash_id_sql("'line'", "value", "ord")} AS _id FROM (
SELECT value, CAST(row_number() OVER (PARTITION BY value) AS VARCHAR) AS ord FROM ({_LINE_LINES}))""")
def document_ids_content(spark, sf):
    """P8 (content mode): the id is a hash of the line and its ordinal among equal lines."""
    p = ps.parse_lines(_line_lines(spark, sf), LINE_TYPE, LINES, id_mode="content")
    return p.filter(F.col("_status") == ps.OK).select(F.col("_line").alias("value"), "_id")


# Orders named by their customer: a key that is not unique.
REPEATED = TypeSpec("order", fx.ORDER_TYPE.field_names, field_sep="|", routing_field="status", key_fields=("custkey",))
REP = IndexSpec("orders", 4, (REPEATED,), partition_fields=("year",))


@query("duplicate_keys", f"""SELECT _index AS index, _id, count(*) AS copies FROM ({O.docs_sql(REPEATED, REP)})
GROUP BY _index, _id HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    """Ids that several documents of an index carry."""
    return du.duplicate_ids(_docs(spark, sf, REP))


@query("shard_distinct_ids", f"""SELECT _index AS index, _shard AS shard, count(*) AS doc_count, count(DISTINCT _id) AS distinct_ids
FROM ({O.docs_sql(REPEATED, REP)}) GROUP BY _index, _shard""")
def shard_distinct_ids(spark, sf):
    """A3 where ids repeat."""
    return agg.shard_stats(_docs(spark, sf, REP)).select("index", "shard", "doc_count", "distinct_ids")


@query("strip_id", f"""SELECT _id, {O.json_doc_sql(EV_FIELDS, None)} AS doc FROM ({EV_DOCS_SQL})""")
def strip_id(spark, sf):
    """The document text without its ``_id``."""
    d = ps.documents(_parsed(spark, sf, EV), fx.EVENT_TYPE, EV, mode="quarantine")
    return d.select("_id", ps.strip_id("doc").alias("doc"))


@query("filter_blank", r"""SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
  CAST(count(*) FILTER (WHERE NOT regexp_full_match(line, '[\x00-\x20]*')) AS BIGINT) AS n_nonblank
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY doc_id""")
def filter_blank(spark, sf):
    """P10: blank records (nothing but characters up to U+0020) are skipped.
    Every line of a document is in its row, so the lines are counted there
    (``doc_id`` is the table's key): no explode, no exchange."""
    d = fx.table(spark, sf, "documents")
    lines = ps.compute_once(d.select("doc_id", F.split("text", "\n", -1).alias("_lines")))
    return lines.select("doc_id", F.size("_lines").cast("bigint").alias("n_lines"),
                        F.size(F.filter("_lines", lambda ln_: ~X.is_blank(ln_))).cast("bigint").alias("n_nonblank"))


# --- routing and naming --------------------------------------------------------

@query("java_hash", f"""SELECT doc_id, {O.java_hash_sql('text')} AS h_text, {O.java_hash_sql('source')} AS h_source,
  {O.java_hash_sql('lang')} AS h_lang FROM documents""")
def java_hash(spark, sf):
    """R1 over whole document texts (any Unicode, surrogate pairs included)."""
    d = fx.table(spark, sf, "documents")
    return d.select("doc_id", X.java_hash("text").alias("h_text"), X.java_hash("source").alias("h_source"),
                    X.java_hash("lang").alias("h_lang"))


@query("shard_routed", f"""SELECT _line AS value, _shard AS shard FROM ({EV_DOCS_SQL})""")
def shard_routed(spark, sf):
    """R2: ``abs(hash % n)`` of the raw routing token."""
    return _parsed(spark, sf, EV).filter(F.col("_status") == ps.OK).select(F.col("_line").alias("value"), F.col("_shard").alias("shard"))


@query("shard_unrouted", f"""SELECT index, shard, type, count(*) AS doc_count FROM ({O.union_docs_sql(PARTS)})
GROUP BY index, shard, type""")
def shard_unrouted(spark, sf):
    """No routing field; the document id is the routing key."""
    return agg.shard_counts(_docs(spark, sf, PARTS))


@query("partition_key", f"""SELECT _line AS value, concat_ws('-', _p_year, _p_month, _p_day) AS partition_key FROM ({EV_DOCS_SQL})""")
def partition_key(spark, sf):
    """Raw partition values joined with ``-``."""
    p = _parsed(spark, sf, EV).filter(F.col("_status") == ps.OK)
    return p.select(F.col("_line").alias("value"), X.partition_key("_p_year", "_p_month", "_p_day").alias("partition_key"))


@query("index_name", f"""SELECT _line AS value, _index AS index FROM ({EV_DOCS_SQL})""")
def index_name(spark, sf):
    """R5."""
    return _parsed(spark, sf, EV).filter(F.col("_status") == ps.OK).select(F.col("_line").alias("value"), F.col("_index").alias("index"))


@query("index_suffix", f"""SELECT DISTINCT index, CASE WHEN instr(index, '@') > 0
  THEN substr(index, instr(index, '@') + 1) END AS suffix FROM ({O.union_docs_sql(UNI)})""")
def index_suffix(spark, sf):
    """Text after the first ``@``."""
    return _docs(spark, sf, UNI).select("index").distinct().select("index", X.index_suffix("index").alias("suffix"))


@query("colocate_shards", f"""SELECT _index AS index, _shard AS shard, _type AS type, _id FROM ({EV_DOCS_SQL})""")
def colocate_shards(spark, sf):
    """Documents clustered by (index, shard) for the write; every
    document survives the rebalance unchanged (the placement itself is
    checked by plan and file tests)."""
    return sk.colocate(_docs(spark, sf, EV)).select("index", "shard", "type", "_id")


# --- joins -----------------------------------------------------------------------

def _per_shard_sql(ispec):
    return f"SELECT index, shard, count(*) AS doc_count FROM ({O.union_docs_sql(ispec)}) GROUP BY index, shard"


@query("shard_grid", O.grid_sql(_per_shard_sql(EV), 10))
def shard_grid(spark, sf):
    """Every shard 0..n-1 of every index seen, empty ones marked."""
    return grd.shard_grid(_docs(spark, sf, EV), 10)


@query("empty_shards", f"""SELECT index, shard FROM ({O.grid_sql(_per_shard_sql(EV64), 64)}) WHERE is_empty""")
def empty_shards(spark, sf):
    """At 64 shards some shards of a day hold nothing."""
    return grd.empty_shards(_docs(spark, sf, EV64), 64)


def _typed_lines_sql():
    return (f"SELECT 'event' AS type, value FROM ({O.EVENTS_LINES}) UNION ALL "
            f"SELECT 'order' AS type, value FROM ({O.ORDERS_LINES})")


def _lookup_sql():
    parts = []
    for t in UNI.types:
        ri = t.routing_index + 1
        f = O.split_sql("value", t.field_sep)
        parts.append(f"""SELECT type, value, CAST(len(f) AS INTEGER) AS n_fields, len(f) = {len(t.field_names)} AS arity_ok,
  f[{ri}] AS routing,
  coalesce(CASE WHEN f[{ri}] IS NOT NULL AND f[{ri}] NOT IN ('', '\\N') THEN {O.routed_shard_sql(f'f[{ri}]', 10)} END, -1) AS shard
FROM (SELECT type, value, {f} AS f FROM ({_typed_lines_sql()}) WHERE type = '{t.name}')""")
    return " UNION ALL ".join(parts)


@query("type_lookup", _lookup_sql())
def type_lookup(spark, sf):
    """Separator, fields and routing come from the line's row of a type table."""
    tagged = (fx.events_lines(spark, sf).select(F.lit("event").alias("type"), "value")
              .unionByName(fx.orders_lines(spark, sf).select(F.lit("order").alias("type"), "value")))
    out = lk.type_lookup(tagged, lk.type_table(spark, UNI), 10)
    # -1: no shard (null routing token); integers stay non-null across engines
    return out.withColumn("shard", F.coalesce("shard", F.lit(-1)))


def _current_manifest(spark, sf):
    """An earlier build of the first ten days, derived from the events table."""
    e = fx.table(spark, sf, "events").filter(F.dayofmonth("ts") <= 10)
    idx = F.concat(F.lit("events@"), F.year("ts").cast("string"), F.lit("-"),
                   F.lpad(F.month("ts").cast("string"), 2, "0"), F.lit("-"),
                   F.lpad(F.dayofmonth("ts").cast("string"), 2, "0"))
    return e.select(idx.alias("index")).distinct().select("index", F.lit(2).alias("version"))


@query("publish_plan", f"""WITH cur AS (SELECT DISTINCT 'events@' || CAST(year(ts) AS VARCHAR) || '-' ||
  lpad(CAST(month(ts) AS VARCHAR), 2, '0') || '-' || lpad(CAST(day(ts) AS VARCHAR), 2, '0') AS index, 2 AS version
  FROM events WHERE day(ts) <= 10),
new AS (SELECT DISTINCT _index AS index FROM ({EV_DOCS_SQL}))
SELECT new.index, CASE WHEN cur.version IS NULL THEN 'create' ELSE 'replace' END AS action,
  coalesce(cur.version, 0) AS previous_version FROM new LEFT JOIN cur ON new.index = cur.index""")
def publish_plan(spark, sf):
    """Create or replace, per index of the new build."""
    plan = lk.publish_plan(_docs(spark, sf, EV).select("index"), _current_manifest(spark, sf))
    # 0: no previous version (a new index)
    return plan.withColumn("previous_version", F.coalesce("previous_version", F.lit(0)))


# --- aggregations ------------------------------------------------------------------

@query("shard_counts", f"""SELECT index, shard, type, count(*) AS doc_count FROM ({O.union_docs_sql(UNI)})
GROUP BY index, shard, type""")
def shard_counts(spark, sf):
    """A1 (exact)."""
    return agg.shard_counts(_docs(spark, sf, UNI))


@query("distinct_shards", f"""SELECT DISTINCT index, shard FROM ({O.union_docs_sql(EV64)})""")
def distinct_shards(spark, sf):
    """A2."""
    return agg.distinct_shards(_docs(spark, sf, EV64))


@query("shard_stats", f"""SELECT _index AS index, _shard AS shard, count(*) AS doc_count, count(DISTINCT _id) AS distinct_ids, min(_id) AS min_id, max(_id) AS max_id,
  CAST(sum(strlen({O.json_doc_sql(EV_FIELDS, '_id')})) AS BIGINT) AS doc_bytes,
  min(uid) AS min_key, max(uid) AS max_key
FROM ({EV_DOCS_SQL}) GROUP BY _index, _shard""")
def shard_stats(spark, sf):
    """A3: per (index, shard) without gathering its documents."""
    ok = _parsed(spark, sf, EV).filter(F.col("_status") == ps.OK)
    d = ok.select(F.col("_index").alias("index"), F.col("_shard").alias("shard"), "_id", "uid",
                  F.to_json(F.struct(*[F.col(c) for c in EV_FIELDS], F.col("_id"))).alias("doc"))
    return agg.shard_stats(d, key_col="uid")


SAMPLE_SPEC = fx.events_spec(2)


@query("sample_per_type", f"""SELECT index, shard, type, _id FROM (
SELECT index, shard, type, _id, row_number() OVER (PARTITION BY index, shard, type ORDER BY _id) AS rn
FROM ({O.union_docs_sql(SAMPLE_SPEC)})) WHERE rn <= 50""")
def sample_per_type(spark, sf):
    """A5: first 50 documents by id of every (index, shard, type)."""
    return agg.sample_per_type(_docs(spark, sf, SAMPLE_SPEC), 50).select("index", "shard", "type", "_id")


@query("infer_mapping", O.inferred_mapping_sql(UNI))
def infer_mapping(spark, sf):
    """Fields with a value, per (index, type), exact over all documents."""
    return mp.infer_mapping(_docs(spark, sf, UNI), UNI)


MAPPED = IndexSpec("activity", 10, (
    TypeSpec("event", fx.EVENT_TYPE.field_names, field_sep=",", routing_field="uid", key_fields=("event_id",),
             mapping=(FieldMapping("event_id", "long"), FieldMapping("event_type", "string", "analyzed"))),
    TypeSpec("order", fx.ORDER_TYPE.field_names, field_sep="|", routing_field="custkey", key_fields=("okey",),
             mapping=(FieldMapping("okey", "long"), FieldMapping("priority", "string", "no"))),
), partition_fields=("year",))


@query("merge_mapping", O.merged_mapping_sql(MAPPED))
def merge_mapping(spark, sf):
    """Explicit properties win, every other seen field is a keyword string."""
    return mp.merge_mapping(_docs(spark, sf, MAPPED), MAPPED)


TEMPLATED = IndexSpec("orders", 10, (
    TypeSpec("order", fx.ORDER_TYPE.field_names, field_sep="|", routing_field="custkey", key_fields=("okey",), mapping={"order": {
        "properties": {"status": {"type": "string", "index": "no"}},
        "dynamic_templates": [
            {"keys": {"match": "*key", "unmatch": "cust*", "mapping": {"type": "long"}}},
            {"years": {"match_pattern": "regex", "match": "ye[a-z]+", "mapping": {"type": "integer", "index": "no"}}},
            {"numbers": {"match": "*", "match_mapping_type": "long", "mapping": {"type": "double"}}},
            {"texts": {"match": "*", "match_mapping_type": "string", "mapping": {"type": "{dynamic_type}", "index": "analyzed"}}}]}}),
), partition_fields=("year",))


@query("merge_mapping_templates", f"""SELECT index, type, field,
  CASE WHEN field = 'status' THEN 'string' WHEN field LIKE '%key' AND field NOT LIKE 'cust%' THEN 'long' WHEN regexp_full_match(field, 'ye[a-z]+') THEN 'integer'
    ELSE 'string' END AS data_type,
  CASE WHEN field = 'status' THEN 'no' WHEN field LIKE '%key' AND field NOT LIKE 'cust%' THEN 'not_analyzed' WHEN regexp_full_match(field, 'ye[a-z]+') THEN 'no'
    ELSE 'analyzed' END AS index_mode,
  CASE WHEN field = 'status' THEN 'explicit' ELSE 'template' END AS origin FROM ({O.inferred_mapping_sql(ORD)})""")
def merge_mapping_templates(spark, sf):
    """Of the fields seen, stated ones win, then the first template whose name
    and type patterns fit."""
    return mp.merge_mapping(_docs(spark, sf, TEMPLATED), TEMPLATED)


@query("index_shards", f"""SELECT index, array_to_string(list_sort(list(shard)), ',') AS shard_list,
  CAST(count(*) AS INTEGER) AS n_shards, CAST(sum(doc_count) AS BIGINT) AS doc_count, bool_or(shard = 0) AS has_shard0
FROM ({_per_shard_sql(EV64)}) GROUP BY index""")
def index_shards(spark, sf):
    """The shards of each index (bounded by the shard count) and the owner shard."""
    return agg.index_shards(agg.shard_counts(_docs(spark, sf, EV64)))


# --- scalar helpers ------------------------------------------------------------------

@query("map_to_str", """SELECT o_orderkey, 'cust:' || CAST(o_custkey AS VARCHAR) || ',priority:' || o_orderpriority
  || ',status:' || o_orderstatus AS s FROM orders""")
def map_to_str(spark, sf):
    """M1: entries sorted by key."""
    o = fx.table(spark, sf, "orders")
    m = F.create_map(F.lit("status"), F.col("o_orderstatus"), F.lit("priority"), F.col("o_orderpriority"),
                     F.lit("cust"), F.col("o_custkey").cast("string"))
    return o.select("o_orderkey", X.map_to_str(m).alias("s"))


def _map_text():
    return F.concat(F.lit("st:"), F.col("o_orderstatus"), F.lit(",pr:"), F.col("o_orderpriority"),
                    F.lit(",k\\,ey:"), F.col("o_custkey").cast("string"), F.lit(":x,st:"),
                    F.col("o_orderkey").cast("string"))


@query("str_to_map", f"""WITH s AS (SELECT o_orderkey, 'st:' || o_orderstatus || ',pr:' || o_orderpriority || ',k\\,ey:'
  || CAST(o_custkey AS VARCHAR) || ':x,st:' || CAST(o_orderkey AS VARCHAR) AS s FROM orders),
e AS (SELECT o_orderkey, unnest({O.split_sql('s', ',')}) AS entry, unnest(range(1, len({O.split_sql('s', ',')}) + 1)) AS i FROM s),
kv AS (SELECT o_orderkey, i, {O.split_sql('entry', ':')}[1] AS key, {O.split_sql('entry', ':')}[2] AS value FROM e)
SELECT o_orderkey, key, value FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey, key ORDER BY i DESC) AS rn FROM kv)
WHERE rn = 1""")
def str_to_map(spark, sf):
    """M2: escapes honoured, extra ``:`` parts ignored, the last duplicate wins."""
    o = fx.table(spark, sf, "orders")
    m = o.select("o_orderkey", X.str_to_map(_map_text()).alias("m"))
    return m.select("o_orderkey", F.explode("m").alias("key", "value"))


# --- index content ----------------------------------------------------------------------

@query("typed_documents", f"""SELECT CAST(partkey AS BIGINT) AS partkey, name, brand, type, CAST(size AS INTEGER) AS size
FROM ({O.docs_sql(fx.PART_TYPE, PARTS)})""")
def typed_documents(spark, sf):
    """L1: values coerced by the explicit mapping (``size`` integer, ``partkey`` long)."""
    recs = _records(spark, sf, PARTS)
    return mp.typed_records(recs, fx.PART_TYPE).select("partkey", "name", "brand", "type", "size")


@query("coercion_rejects", f"""SELECT _type AS type, _line AS value, _reason AS reason
FROM ({O.parsed_sql(fx.PART_TYPE, PARTS, O.PART_LINES)}) WHERE _status = 'rejected'""")
def coercion_rejects(spark, sf):
    """L1 quarantine: values that do not coerce are set aside with a reason."""
    return ps.rejected(_parsed(spark, sf, PARTS))


def _keyword_sql(tspec, ispec, lines=None):
    explicit = tspec.explicit_mapping()
    whole = {"byte", "short", "integer", "long"}
    term = lambda f: f"coalesce(CAST(TRY_CAST({f} AS BIGINT) AS VARCHAR), {f})" if f in explicit and explicit[f].data_type in whole else f
    cols = ", ".join(f"{{'field': '{f}', 'term': {term(f)}}}" for f in po.keyword_fields(tspec))
    return f"""SELECT _index AS index, _shard AS shard, _type AS type, kv.field AS field, kv.term AS term, _id FROM (
SELECT _index, _shard, _type, _id, unnest([{cols}]) AS kv FROM ({O.docs_sql(tspec, ispec, *([lines] if lines else []))})) WHERE kv.term IS NOT NULL"""


@query("keyword_postings", _keyword_sql(fx.ORDER_TYPE, ORD))
def keyword_postings(spark, sf):
    """L2: exact-value postings of every keyword field."""
    return po.keyword_postings(_records(spark, sf, ORD), fx.ORDER_TYPE)


# Order keys with leading zeros or a sign, dates in whole and broken forms.
NUMBERED = TypeSpec("order", ("okey", "custkey", "odate", "stamp"), field_sep="|", routing_field="custkey", key_fields=("okey",),
                    mapping=(FieldMapping("okey", "long"), FieldMapping("custkey", "long"), FieldMapping("odate", "date"),
                             FieldMapping("stamp", "timestamp")))
NUM = IndexSpec("numbered", 4, (NUMBERED,))
_NUM_LINES = """SELECT concat(CASE o_orderkey % 3 WHEN 0 THEN '00' WHEN 1 THEN '+' ELSE '' END, o_orderkey, '|', o_custkey, '|',
  CASE WHEN o_orderkey % 13 = 0 THEN CAST(year(o_orderdate) AS VARCHAR) ELSE strftime(o_orderdate, '%Y-%m-%d') END,
  CASE o_orderkey % 11 WHEN 0 THEN 'Tgarbage' WHEN 1 THEN 'T10:20:30' ELSE '' END, '|', strftime(o_orderdate, '%Y-%m-%d'),
  CASE o_orderkey % 7 WHEN 0 THEN 'T10:20:30' WHEN 1 THEN ' 10:20:30.5Z' WHEN 2 THEN 'T10:20' ELSE 'T00:00:00+02:00' END) AS value FROM orders"""


def _numbered_lines(spark, sf):
    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    pick = lambda c, *cases, other="": F.when(c == cases[0][0], cases[0][1]).when(c == cases[1][0], cases[1][1]).otherwise(other)
    odate = F.concat(F.when(k % 13 == 0, F.year("o_orderdate").cast("string")).otherwise(day), pick(k % 11, (0, "Tgarbage"), (1, "T10:20:30")))
    at = F.concat(day, F.when(k % 7 == 2, "T10:20").otherwise(pick(k % 7, (0, "T10:20:30"), (1, " 10:20:30.5Z"), other="T00:00:00+02:00")))
    line = F.concat_ws("|", F.concat(pick(k % 3, (0, "00"), (1, "+")), k.cast("string")), F.col("o_custkey").cast("string"), odate, at)
    return fx.table(spark, sf, "orders").select(line.alias("value"))


@query("strict_values", f"""SELECT _status AS status, coalesce(_reason, '') AS reason, count(*) AS n
FROM ({O.parsed_sql(NUMBERED, NUM, _NUM_LINES)}) GROUP BY _status, _reason""")
def strict_values(spark, sf):
    """L1: dates and times are taken in whole form only."""
    p = ps.parse_lines(_numbered_lines(spark, sf), NUMBERED, NUM)
    return p.groupBy(F.col("_status").alias("status"), F.coalesce("_reason", F.lit("")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("numeric_terms", f"""SELECT field, term, count(*) AS doc_freq FROM ({_keyword_sql(NUMBERED, NUM, _NUM_LINES)}) GROUP BY field, term""")
def numeric_terms(spark, sf):
    """L2 + L4: a number is one term however it is written."""
    recs = ps.records(ps.parse_lines(_numbered_lines(spark, sf), NUMBERED, NUM), NUMBERED, mode="quarantine")
    return po.term_stats(po.keyword_postings(recs, NUMBERED)).groupBy("field", "term").agg(F.sum("doc_freq").alias("doc_freq"))


# The orders feed as FIXTURES.md states it: the order key is stored but not
# indexed, so keyword terms cover custkey, status, priority and year.
ORDER_KEYED = TypeSpec("order", fx.ORDER_TYPE.field_names, field_sep="|", routing_field="custkey",
                       key_fields=("okey",), mapping=(FieldMapping("okey", "long", "no"),))
ORD_KEYED = IndexSpec("orders", 10, (ORDER_KEYED,), partition_fields=("year",))


@query("orders_mapping", O.merged_mapping_sql(ORD_KEYED))
def orders_mapping(spark, sf):
    """A6 + A7 on the orders feed alone: 7 yearly indices x 5 fields."""
    return mp.merge_mapping(_docs(spark, sf, ORD_KEYED), ORD_KEYED)


@query("orders_term_stats", f"""SELECT index, field, term, count(*) AS doc_freq, CAST(count(*) AS BIGINT) AS total_freq
FROM ({_keyword_sql(ORDER_KEYED, ORD_KEYED)}) GROUP BY index, field, term""")
def orders_term_stats(spark, sf):
    """L4 over keyword postings of the fields that are indexed."""
    return po.term_stats(po.keyword_postings(_records(spark, sf, ORD_KEYED), ORDER_KEYED))


# The English stop words, stated apart from the operator's list.
_STOP = ", ".join(f"'{w}'" for w in (
    "a an and are as at be but by for if in into is it no not of on or such that the their then there these "
    "they this to was will with").split())


def _text_postings_sql(lines=None):
    return f"""SELECT _index AS index, _shard AS shard, _type AS type, 'text' AS field, term, _id, count(*) AS tf FROM (
SELECT _index, _shard, _type, _id, unnest({O.tokens_sql('text')}) AS term
FROM ({O.docs_sql(fx.DOC_TYPE, DOCS, lines)}))
WHERE term <> '' AND term NOT IN ({_STOP})
GROUP BY _index, _shard, _type, term, _id"""


@query("text_postings", _text_postings_sql())
def text_postings(spark, sf):
    """L3: analysed text postings with term frequency, on whole document texts."""
    return po.text_postings(_records(spark, sf, DOCS), fx.DOC_TYPE)


@query("term_stats", f"""SELECT index, field, term, count(*) AS doc_freq, CAST(count(*) AS BIGINT) AS total_freq
FROM ({_keyword_sql(fx.ORDER_TYPE, ORD)}) GROUP BY index, field, term""")
def term_stats(spark, sf):
    """L4 over keyword postings."""
    return po.term_stats(po.keyword_postings(_records(spark, sf, ORD), fx.ORDER_TYPE))


@query("text_term_stats", f"""SELECT index, field, term, count(*) AS doc_freq, CAST(sum(tf) AS BIGINT) AS total_freq
FROM ({_text_postings_sql()}) GROUP BY index, field, term""")
def text_term_stats(spark, sf):
    """L4 over text postings."""
    return po.term_stats(po.text_postings(_records(spark, sf, DOCS), fx.DOC_TYPE))


# --- sinks, manifests, publish ----------------------------------------------------------

def _build_postings_sql(by="index, field, term", lines=None):
    return f"""SELECT {by}, count(*) AS doc_freq, CAST(sum(tf) AS BIGINT) AS total_freq FROM (
SELECT index, field, term, 1 AS tf FROM ({_keyword_sql(fx.DOC_TYPE, DOCS, lines)})
UNION ALL SELECT index, field, term, tf FROM ({_text_postings_sql(lines)})) GROUP BY {by}"""

CREATED_AT = _dt.datetime(2024, 2, 1)


def _build(spark, sf, ispec, name, mode="quarantine", inputs=None, postings=False):
    out = scratch_path(spark, name)
    inputs = inputs or fx.feed_inputs(spark, sf, ispec)
    return build_index(spark, ispec, out, inputs=inputs, mode=mode, created_at=CREATED_AT,
                       postings=postings), out


@query("sink_documents", f"""SELECT index, shard, type, count(*) AS doc_count FROM ({O.union_docs_sql(UNI)})
GROUP BY index, shard, type""")
def sink_documents(spark, sf):
    """K1: written by index (shard a column), read back."""
    res, _ = _build(spark, sf, UNI, "sink")
    return agg.shard_counts(res.documents)


@query("sink_typed", f"""SELECT index, okey_text, CAST(okey AS BIGINT) AS okey, CAST(custkey AS BIGINT) AS custkey, date_diff('day', DATE '1970-01-01', CAST(odate AS DATE)) AS odate_day,
  epoch_us(CASE WHEN regexp_matches(stamp, '(Z|[+-][0-9:]+)$') AND length(stamp) > 19 THEN CAST(stamp AS TIMESTAMPTZ)::TIMESTAMPTZ ELSE
  CAST(concat(replace(stamp, ' ', 'T'), 'Z') AS TIMESTAMPTZ) END) AS stamp_us
FROM (SELECT _index AS index, okey AS okey_text, * EXCLUDE (_index) FROM ({O.docs_sql(NUMBERED, NUM, _NUM_LINES)}))""")
def sink_typed(spark, sf):
    """L1: numbers, dates and times read back from the written documents in their types,
    beside the document text, which holds them as they came."""
    out = scratch_path(spark, "typed")
    build_index(spark, NUM, out, inputs={"order": _numbered_lines(spark, sf)}, mode="quarantine", created_at=CREATED_AT)
    text = sk.active_documents(spark, out).select("_id", F.get_json_object("doc", "$.okey").alias("okey_text"))
    typed = sk.read_typed(spark, out, NUMBERED)
    return typed.join(text, "_id").select("index", "okey_text", "okey", "custkey", F.unix_date("odate").cast("bigint").alias("odate_day"), F.unix_micros("stamp").alias("stamp_us"))


def _manifest_sql(ispec):
    merged = O.merged_mapping_sql(ispec)
    return f"""WITH m AS ({merged}),
mj AS (SELECT index, type, '{{"properties":{{' || string_agg('"' || field || '":{{"type":"' || data_type
   || '","index":"' || index_mode || '"}}', ',' ORDER BY field) || '}}}}' AS mapping FROM m GROUP BY index, type),
mm AS (SELECT index, string_agg('"' || type || '":' || mapping, ',' ORDER BY type) AS mappings_json FROM mj GROUP BY index),
c AS (SELECT index, count(*) AS doc_count FROM ({O.union_docs_sql(ispec)}) GROUP BY index)
SELECT c.index, {ispec.num_shards} AS num_shards, {ispec.replicas} AS replicas, {ispec.version} AS version,
  'open' AS state, CASE WHEN instr(c.index, '@') > 0 THEN substr(c.index, instr(c.index, '@') + 1) END AS partition_key,
  CAST(c.doc_count AS BIGINT) AS doc_count, '{{' || mm.mappings_json || '}}' AS mappings_json
FROM c LEFT JOIN mm ON c.index = mm.index"""


@query("build_postings", _build_postings_sql())
def build_postings(spark, sf):
    """L2-L4 inside the build: postings and the term dictionary written by
    index from the documents table (one scan of it), read back."""
    res, _ = _build(spark, sf, DOCS, "postings", postings=True)
    return res.terms.select("index", "field", "term", "doc_freq", "total_freq")


_LONG = 1000          # characters of the texts that the rebuilt index keeps


@query("active_terms", _build_postings_sql("field, term", f"""SELECT l.value FROM ({O.DOCS_LINES}) l
  JOIN documents d ON l.src_key = d.doc_id WHERE d.lang <> 'de' OR d.n_chars >= {_LONG}"""))
def active_terms(spark, sf):
    """L4 kept current: the dictionary of all languages after one language's index is
    replaced by a build of its long texts, from the counts that came and went."""
    live = scratch_path(spark, "terms")
    d = fx.table(spark, sf, "documents")
    german = d.where(f"lang = 'de' and n_chars >= {_LONG}").select(F.col("doc_id").cast("string").alias("k"))
    key = F.substring_index("value", ",", 1)
    feeds = (fx.docs_lines(spark, sf), fx.docs_lines(spark, sf).join(german, key == F.col("k"), "left_semi"))
    for lines in feeds:
        out = scratch_path(spark, "terms-build")
        build_index(spark, DOCS, out, inputs={"doc": lines}, mode="quarantine", created_at=CREATED_AT, postings=True)
        sk.publish(spark, out, live)
        got = dc.active_terms(spark, live)
    return got


@query("index_manifest", _manifest_sql(MAPPED))
def index_manifest(spark, sf):
    """K2: one row per index, mappings of every type seen in any shard."""
    res, _ = _build(spark, sf, MAPPED, "manifest")
    m = res.manifest
    entries = F.sort_array(F.map_entries("mappings"))
    mj = F.concat(F.lit("{"), F.array_join(F.transform(
        entries, lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"])), ","), F.lit("}"))
    return m.select("index", "num_shards", "replicas", "version", "state", "partition_key", "doc_count",
                    mj.alias("mappings_json"))


@query("shard_manifest", f"""SELECT index, shard, doc_count, is_empty, 2 AS version, true AS "primary"
FROM ({O.grid_sql(_per_shard_sql(EV), 10)})""")
def shard_manifest(spark, sf):
    """K3: every shard of every index with its state record."""
    res, _ = _build(spark, sf, EV, "shards")
    return res.shards.select("index", "shard", "doc_count", "is_empty", "version", "primary")


def _days(spark, sf, lo, hi):
    return fx.events_lines(spark, sf, days=(lo, hi))


EV4 = fx.events_spec(4)
EV2 = fx.events_spec(2)


def _publish_sql():
    def part(spec, lo, hi):
        lines = f"SELECT l.value FROM ({O.EVENTS_LINES}) l JOIN events e ON l.src_key = e.event_id WHERE day(e.ts) BETWEEN {lo} AND {hi}"
        return f"SELECT _index AS index, _shard AS shard FROM ({O.docs_sql(fx.EVENT_TYPE, spec, lines)})"
    return f"""SELECT index, shard, count(*) AS doc_count FROM (
{part(EV4, 1, 4)} UNION ALL {part(EV2, 5, 31)}) GROUP BY index, shard"""


@query("publish_replace", _publish_sql())
def publish_replace(spark, sf):
    """K4: a rebuild of days 5.. with 2 shards replaces those indices whole
    (no stale shards 2-3 left), days 1-4 of the old 4-shard build stay."""
    live = scratch_path(spark, "live")
    old, old_out = _build(spark, sf, EV4, "old", inputs={"event": _days(spark, sf, 1, 10)})
    sk.publish(spark, old_out, live)
    new, new_out = _build(spark, sf, EV2, "new", inputs={"event": _days(spark, sf, 5, 31)})
    sk.publish(spark, new_out, live)
    return sk.active_documents(spark, live).groupBy("index", "shard").agg(F.count(F.lit(1)).alias("doc_count"))


@query("active_documents", f"""SELECT index, count(*) AS doc_count FROM (
SELECT _index AS index FROM ({O.docs_sql(fx.EVENT_TYPE, EV, f"SELECT l.value FROM ({O.EVENTS_LINES}) l JOIN events e ON l.src_key = e.event_id WHERE day(e.ts) <= 10")}))
GROUP BY index""")
def active_documents(spark, sf):
    """K5: what was copied without a manifest row is not active, whether its
    index is new (days 11..) or a rebuild of a listed one (days 5..); a later
    publication of the older build is a rollback."""
    live = scratch_path(spark, "active")
    first, out = _build(spark, sf, EV, "act", inputs={"event": _days(spark, sf, 1, 10)})
    sk.publish(spark, out, live)
    # a replacement, published, then rolled back
    _, again = _build(spark, sf, EV2, "act2", inputs={"event": _days(spark, sf, 3, 4)})
    sk.publish(spark, again, live)
    sk.publish(spark, out, live)
    # a copy that never reached its activation step
    rows = ps.build_rows(ps.parse_lines(_days(spark, sf, 5, 31), fx.EVENT_TYPE, EV), fx.EVENT_TYPE, EV,
                         mode="quarantine")
    sk.write_documents(rows, live, "unlisted")
    return sk.active_documents(spark, live).groupBy("index").agg(F.count(F.lit(1)).alias("doc_count"))


def _days_sql(spec, lo, hi):
    lines = f"SELECT l.value FROM ({O.EVENTS_LINES}) l JOIN events e ON l.src_key = e.event_id WHERE day(e.ts) BETWEEN {lo} AND {hi}"
    return f"SELECT _index AS index, _shard AS shard FROM ({O.docs_sql(fx.EVENT_TYPE, spec, lines)})"


@query("publish_race", f"""SELECT index, count(DISTINCT side) AS n_publications, CAST(count(*) FILTER (side = 2 OR NOT twice) AS BIGINT) AS doc_count FROM (
SELECT *, max(side) OVER (PARTITION BY index) <> min(side) OVER (PARTITION BY index) AS twice FROM (
SELECT index, 1 AS side FROM ({_days_sql(EV4, 1, 10)}) UNION ALL SELECT index, 2 AS side FROM ({_days_sql(EV2, 5, 31)}))) GROUP BY index""")
def publish_race(spark, sf):
    """K4: two publishers at once, both having read the folder before either has
    published: each gets a number of its own, no index is lost, and every
    index shows one build whole (days 5-10 are in both)."""
    live = scratch_path(spark, "race")
    outs = [_build(spark, sf, spec, "racer", inputs={"event": _days(spark, sf, lo, hi)})[1] for spec, lo, hi in ((EV4, 1, 10), (EV2, 5, 31))]
    with ThreadPoolExecutor(2) as pool:
        for done in [pool.submit(sk.publish, spark, out, live) for out in outs]:
            done.result()
    told = sk.read_table(spark, live, "manifest").groupBy("index").agg(F.countDistinct("publish_seq").alias("n_publications"))
    docs = sk.active_documents(spark, live).groupBy("index").agg(F.count(F.lit(1)).alias("doc_count"))
    return told.join(docs, "index").select("index", "n_publications", "doc_count")


def _three_publications(spark, sf, name):
    """Days 1-10, then days 5-31, then days 8-12 again, published one after the other."""
    live = scratch_path(spark, name)
    for build_id, spec, lo, hi in (("first", EV4, 1, 10), ("second", EV2, 5, 31), ("third", EV4, 8, 12)):
        out = scratch_path(spark, name)
        build_index(spark, spec, out, inputs={"event": _days(spark, sf, lo, hi)}, mode="quarantine", build_id=build_id, created_at=CREATED_AT)
        sk.publish(spark, out, live)
    return live


@query("removable_builds", f"""SELECT DISTINCT index, 'first' AS build_id, CAST(1 AS BIGINT) AS publish_seq, CAST(2 AS BIGINT) AS replaced_seq
FROM ({_days_sql(EV4, 5, 10)}) WHERE index IN (SELECT index FROM ({_days_sql(EV2, 5, 31)}))""")
def removable_builds(spark, sf):
    """K4: with one publication to go back to, the builds replaced by the second
    of three publications are out of reach, those replaced by the third are not."""
    return sk.removable_builds(spark, _three_publications(spark, sf, "removable"), keep=1).drop("stored")


@query("active_as_of", f"""SELECT index, shard, count(*) AS doc_count FROM ({_days_sql(EV4, 1, 4)} UNION ALL {_days_sql(EV2, 5, 31)}) GROUP BY index, shard""")
def active_as_of(spark, sf):
    """K5: the documents as of the second publication, after a third and after
    the removal of what the second had replaced."""
    live = _three_publications(spark, sf, "as-of")
    sk.remove_replaced(spark, live, keep=1)
    return sk.active_documents(spark, live, as_of=2).groupBy("index", "shard").agg(F.count(F.lit(1)).alias("doc_count"))


@query("rejected_lines", f"""SELECT 'arity' AS reason, l.value, count(*) AS n FROM ({O.EVENTS_LINES}) l
WHERE l.src_key % 29 = 0 AND l.src_key % 17 <> 0 AND l.src_key % 19 <> 0 GROUP BY l.value""")
def rejected_lines(spark, sf):
    """K1: the quarantined lines of two builds in one folder, both still there."""
    out = scratch_path(spark, "rejected")
    for days in ((1, 15), (16, 31)):
        build_index(spark, EV, out, inputs={"event": _days(spark, sf, *days)}, mode="quarantine", created_at=CREATED_AT)
    return sk.read_rejected(spark, out).groupBy("reason", "value").agg(F.count(F.lit(1)).alias("n"))


# --- end to end ---------------------------------------------------------------------------

@query("build_index_summary", O.grid_sql(_per_shard_sql(EV), 10))
def build_index_summary(spark, sf):
    """The sample job on the events feed; documents per (index, shard)
    with empty shards shown, read from the written shard table."""
    res, _ = _build(spark, sf, EV, "e2e")
    return res.shards.select("index", "shard", "doc_count", "is_empty")
