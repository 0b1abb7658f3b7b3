"""Index manifest (K2), shard manifest (K3) and the log of publications (K4, K5).

The manifest of a folder is a log::

    manifest/commits/<number>      names the rows of publication <number>
    manifest/snapshots/<number>    names the rows of a snapshot after <number>
    manifest/rows/<id>/            manifest rows, written by Spark before they are named

A publication is the making of its commit file, which only one publisher can do for a
number: the others read the log again and try the next number.  A reader lists the log
and reads the last snapshot and the rows committed since, so it sees whole publications
only, and two readers of the same numbers see the same.  A snapshot holds the last row of
every (index, build) that is still kept; it is written every ``SNAPSHOT_EVERY`` numbers,
and nothing depends on it being there.

A row names the build that is published (``build_id``) and the folder that holds its
files (``stored``): the build's own, or that of a copy of it.
"""

from __future__ import annotations

import datetime as _dt
import uuid as _uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ids import hash_id
from ..functions.naming import index_suffix
from ..operators.mapping import mapping_json
from ..spec import IndexSpec
from . import files
from .layout import MANIFEST, SCHEMAS, table_path

# Fixed values of the shard state record.
SHARD_STATE_VERSION = 2
SHARD_STATE_PRIMARY = True

SNAPSHOT_EVERY = 32          # publications between two snapshots
PUBLISHED, REMOVED = "publish", "remove"
COLUMNS = ("index", "uuid", "num_shards", "replicas", "version", "created_at", "state", "partition_key", "mappings", "doc_count",
           "build_id", "columns", "publish_seq", "action", "stored")


def shard_manifest(grid: DataFrame) -> DataFrame:
    """K3: every shard of every index, with the constant shard state."""
    return grid.select("index", "shard", "doc_count", "is_empty",
                       F.lit(SHARD_STATE_VERSION).alias("version"),
                       F.lit(SHARD_STATE_PRIMARY).alias("primary"))


def index_manifest(grid: DataFrame, mapping: DataFrame, ispec: IndexSpec, *,
                   build_id: str, columns: str, created_at: _dt.datetime | None = None,
                   open_: bool = True) -> DataFrame:
    """K2: one row per index.  The mapping of every type seen in any shard
    of the index is included (not only the types of shard 0)."""
    per_index = grid.groupBy("index").agg(F.sum("doc_count").cast("bigint").alias("doc_count"))
    mj = mapping_json(mapping)
    maps = mj.groupBy("index").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("type", "mapping")))).alias("mappings"))
    created = F.lit(created_at).cast("timestamp") if created_at is not None else F.current_timestamp()
    return (per_index.join(maps, "index", "left")
            .select("index",
                    hash_id(F.lit(build_id), F.col("index")).alias("uuid"),
                    F.lit(ispec.num_shards).alias("num_shards"),
                    F.lit(ispec.replicas).alias("replicas"),
                    F.lit(ispec.version).alias("version"),
                    created.alias("created_at"),
                    F.lit("open" if open_ else "close").alias("state"),
                    index_suffix("index").alias("partition_key"),
                    "mappings", "doc_count", F.lit(build_id).alias("build_id"), F.lit(columns).alias("columns"),
                    F.lit(build_id).alias("stored")))


# --- the log -------------------------------------------------------------------------------

@dataclass(frozen=True)
class Log:
    """What a reader needs of the log up to a number: its last snapshot and the commits after it."""

    out: str
    last: int                              # highest number (0: nothing is published)
    snapshot: str | None                   # rows of the snapshot
    tail: tuple[tuple[int, str], ...]      # numbers and rows after the snapshot


def _folder(out: str, kind: str) -> str:
    return f"{table_path(out, MANIFEST)}/{kind}"


def _name(number: int) -> str:
    return f"{number:012d}"


def _numbers(spark: SparkSession, out: str, kind: str) -> list[int]:
    return [int(n) for n in files.names(spark, _folder(out, kind)) if n.isdigit()]


def _named(spark: SparkSession, out: str, kind: str, number: int) -> str:
    return files.read_text(spark, f"{_folder(out, kind)}/{_name(number)}").strip()


def read_log(spark: SparkSession, out: str, as_of: int | None = None, whole: bool = False) -> Log:
    """The log, as of a number if one is given; ``whole`` without the short cut by a snapshot."""
    commits = [n for n in _numbers(spark, out, "commits") if as_of is None or n <= as_of]
    last = max(commits, default=0)
    start = 0 if whole else max((n for n in _numbers(spark, out, "snapshots") if n <= last), default=0)
    tail = tuple((n, _named(spark, out, "commits", n)) for n in commits if n > start)
    return Log(out, last, _named(spark, out, "snapshots", start) if start else None, tail)


def _rows_path(out: str, rows: str) -> str:
    return f"{_folder(out, 'rows')}/{rows}"


def log_rows(spark: SparkSession, log: Log) -> DataFrame:
    """All rows of the log's tail (with their number), after those of its snapshot."""
    schema = SCHEMAS[MANIFEST]
    out = spark.createDataFrame([], schema)
    if log.tail:
        rows = spark.read.schema(f"{schema}, commit_id string").parquet(*[_rows_path(log.out, r) for _, r in log.tail]).drop("publish_seq")
        # one row a publication since the snapshot
        numbers = spark.createDataFrame([(r, n) for n, r in log.tail], "commit_id string, publish_seq bigint")
        out = rows.join(F.broadcast(numbers), "commit_id").select(*COLUMNS)
    if log.snapshot:
        out = out.unionByName(spark.read.schema(schema).parquet(_rows_path(log.out, log.snapshot)))
    return out


def publications(spark: SparkSession, out: str) -> DataFrame:
    """Every row ever published (of every number; builds that were removed since too)."""
    return log_rows(spark, read_log(spark, out, whole=True)).where(F.col("action") == PUBLISHED)


def publication(spark: SparkSession, out: str, number: int) -> DataFrame:
    """The rows of one publication."""
    return log_rows(spark, Log(out, number, None, ((number, _named(spark, out, "commits", number)),)))


def kept_builds(spark: SparkSession, log: Log) -> DataFrame:
    """The last row of every (index, folder) that was published and not removed."""
    w = Window.partitionBy("index", "stored").orderBy(F.col("publish_seq").desc())
    last = log_rows(spark, log).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return last.where(F.col("action") == PUBLISHED)


def current_rows(kept: DataFrame) -> DataFrame:
    """Of the kept builds, the one of each index that was published last."""
    w = Window.partitionBy("index").orderBy(F.col("publish_seq").desc())
    return kept.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def current_manifest(spark: SparkSession, out: str, as_of: int | None = None) -> DataFrame:
    """The manifest row of every index's last publication, or of the last one up to
    the number ``as_of`` (its builds are readable as long as they are kept)."""
    return current_rows(kept_builds(spark, read_log(spark, out, as_of)))


def commit(spark: SparkSession, out: str, rows_at: Callable[[Log], DataFrame | None], action: str = PUBLISHED) -> int | None:
    """Append to the log what ``rows_at`` makes of its present state; the number, or
    ``None`` if it makes nothing of it.

    Optimistic: the rows are made and written against the state as read, and count if the
    next number is still free then.  If another publisher took it, the log is read again
    and the rows are made anew against the new state.
    """
    while True:
        log = read_log(spark, out)
        rows = rows_at(log)
        if rows is None:
            return None
        name = _uuid.uuid4().hex
        rows = rows.withColumns({"action": F.lit(action), "commit_id": F.lit(name), "publish_seq": F.lit(None).cast("bigint")})
        rows.select(*COLUMNS, "commit_id").write.parquet(_rows_path(out, name))
        if files.put_if_absent(spark, f"{_folder(out, 'commits')}/{_name(log.last + 1)}", name):
            if (log.last + 1) % SNAPSHOT_EVERY == 0:
                write_snapshot(spark, out, log.last + 1)
            return log.last + 1
        files.delete(spark, _rows_path(out, name))


def write_snapshot(spark: SparkSession, out: str, number: int) -> None:
    """The kept builds as of ``number``; a second snapshot of a number is dropped."""
    name = f"snapshot-{_uuid.uuid4().hex}"
    kept_builds(spark, read_log(spark, out, as_of=number)).select(*COLUMNS).write.parquet(_rows_path(out, name))
    if not files.put_if_absent(spark, f"{_folder(out, 'snapshots')}/{_name(number)}", name):
        files.delete(spark, _rows_path(out, name))


def append_manifest(spark: SparkSession, rows: DataFrame, out: str) -> int:
    """Publish ``rows`` under the next free number: the switch."""
    return commit(spark, out, lambda log: rows)


__all__ = ["Log", "SNAPSHOT_EVERY", "append_manifest", "commit", "current_manifest", "current_rows", "index_manifest", "kept_builds",
           "log_rows", "publication", "publications", "read_log", "shard_manifest", "write_snapshot"]
