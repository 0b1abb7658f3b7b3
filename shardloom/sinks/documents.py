"""Document tables: write (K1), publish with whole-index replacement and the removal of
what was replaced (K4), activation through the manifest (K5).

Layout under an output or live folder::

    documents/build_id=<folder>/index=<index>/part-*.parquet
                             shard is a column; rejected lines sit under the
                             null index of their build
    shards/, mapping/, postings/, terms/   the same two levels
    _stats/build_id=<build>/               counts and field presence
    manifest/                the log of publications (see ``manifest``)
    manifest/builds/<build>  the claim of a build id

A build has folders of its own (an id is claimed once and never written again), and so
has every copy that a publication makes.  Which of them is read for an index is decided
by the manifest alone: the row with the highest ``publish_seq``.  A copy without a
manifest row is invisible, a later publication of an older build rolls back, and
publishing what is already current changes nothing.  The manifest row also holds the
columns of the build's documents, so folders with several specs are read by a stated
schema (the union of those columns), not by one file's footer.
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid as _uuid
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.parse import typed_column_name, typed_field_name, typed_fields
from ..session import ROW_GROUP_BYTES, scratch_path, table_exists
from ..spec import DATA_TYPES, TypeSpec
from . import files
from .dictionary import has_dictionary, refresh_terms
from .layout import (DOCUMENTS, MANIFEST, MAPPING, POSTINGS, REJECTED_COLUMNS, SCHEMAS, SHARDS, STATS, TERMS,
                     build_path, ddl, quoted, table_path)
from .manifest import (PUBLISHED, REMOVED, Log, commit, current_manifest, current_rows, kept_builds, log_rows, publications,
                       read_log)

TABLES = (DOCUMENTS, SHARDS, MAPPING, POSTINGS, TERMS)


def colocate(docs: DataFrame) -> DataFrame:
    """Cluster rows by (index, shard) for the write.

    A REBALANCE rather than a plain repartition: AQE sizes the partitions
    and splits a hot (index, shard) over several tasks instead of giving one
    task a third of the data; each index folder then gets a few large files
    rather than one small file per input task.
    """
    return docs.hint("rebalance", "index", "shard").sortWithinPartitions("index", "shard")


def by_index(df: DataFrame) -> DataFrame:
    """Cluster an aggregated table by ``index`` before its partitioned write.

    An aggregate leaves every task holding rows of every index, and a write
    partitioned by ``index`` would then open one file per (task, index):
    with thousands of indices, millions of small files.  A REBALANCE on
    ``index`` lets AQE size the partitions (a large index is split over
    several tasks, small ones share one), so each index gets a few files.
    """
    return df.hint("rebalance", "index")


def claim_build(spark: SparkSession, out: str, build_id: str) -> None:
    """Take a build id in a folder; an error if it was taken before, also by a build that failed."""
    if not re.fullmatch(r"[A-Za-z0-9._-]+", build_id):
        raise ValueError(f"a build id holds letters, digits, '.', '_' and '-' only: {build_id!r}")
    if not files.put_if_absent(spark, f"{table_path(out, MANIFEST)}/builds/{build_id}", build_id):
        raise ValueError(f"build {build_id!r} exists in {out}; what a build wrote is never overwritten")


def write_index_table(df: DataFrame, out: str, name: str, build_id: str) -> None:
    """Write one build's rows of a table into a folder that no one else writes."""
    size = {"parquet.block.size": str(ROW_GROUP_BYTES)} if name == DOCUMENTS else {}
    df.drop("build_id").write.options(**size).partitionBy("index").parquet(build_path(out, name, build_id))


def write_documents(rows: DataFrame, out: str, build_id: str) -> None:
    """K1: the one large write of a build (one exchange, on (index, shard))."""
    write_index_table(colocate(rows), out, DOCUMENTS, build_id)


def _document_columns(spark: SparkSession, out: str) -> str:
    """The union of the document columns of the builds that the manifest names."""
    told = kept_builds(spark, read_log(spark, out)).agg(F.sort_array(F.collect_set("columns"))).first()[0]   # one string per layout
    fields: dict[str, T.DataType] = {}
    for columns in told:
        for f in T.StructType.fromDDL(columns).fields:
            seen = fields.setdefault(f.name, f.dataType)
            if isinstance(seen, T.StructType):             # typed fields of several specs: all of them
                names = {x.name for x in seen.fields}
                fields[f.name] = T.StructType(seen.fields + [x for x in f.dataType.fields if x.name not in names])
    return ", ".join(f"{quoted(n)} {ddl(t)}" for n, t in fields.items()) or "type string, value string, reason string"


def read_table(spark: SparkSession, out: str, name: str) -> DataFrame:
    """All rows of a table, of every folder (its name is the column ``build_id``); of the
    manifest, all rows published."""
    if name == MANIFEST:
        return publications(spark, out)
    columns = _document_columns(spark, out) if name == DOCUMENTS else SCHEMAS[name]
    return spark.read.schema(f"{columns}, build_id string, index string").parquet(table_path(out, name))


def active_table(spark: SparkSession, out: str, name: str, as_of: int | None = None) -> DataFrame:
    """K5: rows of the build that is current for each index, or was as of a publication number."""
    listed = current_manifest(spark, out, as_of).select("index", "stored", F.col("build_id").alias("_build"))
    rows = read_table(spark, out, name).withColumnRenamed("build_id", "stored")
    # one row an index, of a size Spark cannot tell: a shuffle would put an index in one task
    return rows.join(F.broadcast(listed), ["index", "stored"]).withColumnRenamed("_build", "build_id").drop("stored")


def active_documents(spark: SparkSession, out: str, as_of: int | None = None) -> DataFrame:
    return active_table(spark, out, DOCUMENTS, as_of).drop(*REJECTED_COLUMNS)


def read_typed(spark: SparkSession, out: str, tspec: TypeSpec, as_of: int | None = None) -> DataFrame:
    """L1: ``(index, shard, _id, <fields>)`` of the active documents of a type: the fields
    that its mapping gives a type, as the build wrote them in that type.

    Only the asked fields are read from the files.  A field that an older build wrote
    in another type is cast; a value that the type cannot hold is null then.
    """
    docs = active_documents(spark, out, as_of).where(F.col("type") == tspec.name)
    group = typed_column_name(tspec)
    held = [f.name for f in docs.schema[group].dataType.fields] if group in docs.columns else []
    cols = []
    for name, data_type in typed_fields(tspec):
        own = typed_field_name(name, data_type)
        other = [n for n in held if n != own and n.rpartition(":")[0] == name]
        kind = DATA_TYPES[data_type]
        values = [F.col(f"{quoted(group)}.{quoted(n)}").try_cast(kind) if n != own else F.col(f"{quoted(group)}.{quoted(n)}")
                  for n in ([own] if own in held else []) + other]
        cols.append((F.coalesce(*values) if values else F.lit(None).cast(kind)).alias(name))
    return docs.select("index", "shard", "_id", *cols)


def read_documents(spark: SparkSession, out: str) -> DataFrame:
    """Documents of a folder: the current builds, or all rows of a stream's
    folder (which has no manifest)."""
    if files.exists(spark, table_path(out, MANIFEST)):
        return active_documents(spark, out)
    return spark.read.parquet(table_path(out, DOCUMENTS)).where("index is not null").drop(*REJECTED_COLUMNS)


def read_rejected(spark: SparkSession, out: str, with_build: bool = False) -> DataFrame:
    """Quarantined lines of every build in the folder."""
    columns = "type string, value string, reason string, index string"
    with_builds = files.exists(spark, table_path(out, MANIFEST))
    df = spark.read.schema(columns + (", build_id string" if with_builds else "")).parquet(table_path(out, DOCUMENTS))
    return df.where("index is null").select("type", "value", "reason", *["build_id"] * (with_build and with_builds))


# --- publish ----------------------------------------------------------------------------------

def publish(spark: SparkSession, build_out: str, live_out: str, build_id: str | None = None) -> DataFrame:
    """K4 + K5: make the indices of a build folder (of one build with ``build_id``, else
    the current build of each index) current in the live folder; returns the rows
    published.

    What the live folder does not hold yet is copied into a folder of its own (a plain
    distributed read and write), then one commit switches the readers over: a failure
    before it leaves the live indices as they were.  Of several publishers at once each
    gets a number of its own; one that loses a number looks at the new state first, so
    what another has made current meanwhile is not published again, and what it has copied
    is not copied again.  A build that lies in the live folder already is not copied.
    """
    given = current_manifest(spark, build_out) if build_id is None else \
        publications(spark, build_out).where(F.col("build_id") == build_id).dropDuplicates(["index"])
    given = _fixed(given, scratch_path(spark, "publish"))
    copies: list[DataFrame] = []
    made: list[DataFrame] = []

    def rows_at(log: Log) -> DataFrame | None:
        kept = kept_builds(spark, log)
        fresh = given.join(current_rows(kept).select("index", "build_id"), ["index", "build_id"], "left_anti")
        if fresh.isEmpty():
            return None
        lying = kept.groupBy("index", "build_id").agg(F.max_by("stored", "publish_seq").alias("lies"))
        for c in copies:
            lying = c.join(lying, ["index", "build_id"], "left_anti").unionByName(lying)
        fresh = _fixed(fresh.join(lying, ["index", "build_id"], "left"), scratch_path(spark, "publish"))
        missing = fresh.where("lies is null")
        if not missing.isEmpty():
            if build_out.rstrip("/") == live_out.rstrip("/"):
                raise ValueError(f"a build to be published was removed from {live_out}")
            copies.append(_copy(spark, missing, build_out, live_out))
            fresh = fresh.join(copies[-1].withColumnRenamed("lies", "_new"), ["index", "build_id"], "left") \
                .withColumn("lies", F.coalesce("lies", "_new")).drop("_new")
        made.append(fresh.withColumn("stored", F.col("lies")).drop("lies"))
        return made[-1]

    number = commit(spark, live_out, rows_at)
    return made[-1].withColumn("publish_seq", F.lit(number).cast("bigint")) if number else given.limit(0)


def _copy(spark: SparkSession, rows: DataFrame, build_out: str, live_out: str) -> DataFrame:
    """Copy the files of the rows' indices into one new folder; ``(index, build_id, lies)``."""
    folder = f"copy-{_uuid.uuid4().hex}"
    wanted = rows.select("index", F.col("stored").alias("build_id"))
    for name in TABLES:
        if table_exists(spark, table_path(build_out, name), SCHEMAS.get(name, "index string")):
            df = read_table(spark, build_out, name).join(wanted, ["index", "build_id"], "left_semi")
            write_index_table(df.drop(*REJECTED_COLUMNS), live_out, name, folder)
    return rows.select("index", "build_id", F.lit(folder).alias("lies"))


def _fixed(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- removal ------------------------------------------------------------------------------------

def removable_builds(spark: SparkSession, out: str, keep: int = 1, log: Log | None = None) -> DataFrame:
    """``(index, build_id, stored, publish_seq, replaced_seq)`` of every kept (index, folder)
    that no reader of the present state or of the states ``keep`` publications back can reach.

    A row of the log is current from its own number to the next one of its index; a folder
    is needed while one of its rows is current at a number from ``last - keep`` on.
    """
    if keep < 0:
        raise ValueError("keep must not be negative")
    log = log or read_log(spark, out)
    cut = log.last - keep
    if cut < 1:
        return spark.createDataFrame([], "index string, build_id string, stored string, publish_seq bigint, replaced_seq bigint")
    # from the state at the cut on; rows before it are there by their last number, which is enough
    seen = read_log(spark, out, as_of=cut)
    after = Log(out, log.last, seen.snapshot, seen.tail + tuple((n, r) for n, r in read_log(spark, out, whole=True).tail if cut < n <= log.last))
    w = Window.partitionBy("index").orderBy("publish_seq")
    told = log_rows(spark, after)
    spans = told.where(F.col("action") == PUBLISHED).withColumn("replaced_seq", F.lead("publish_seq").over(w))
    removed = told.where(F.col("action") == REMOVED).select("index", "stored")
    last = Window.partitionBy("index", "stored").orderBy(F.col("publish_seq").desc())
    spans = spans.withColumn("_rn", F.row_number().over(last)).where("_rn = 1 and replaced_seq <= " + str(cut))
    return spans.join(removed, ["index", "stored"], "left_anti").select("index", "build_id", "stored", "publish_seq", "replaced_seq")


def unlisted_builds(spark: SparkSession, out: str, before: _dt.datetime) -> DataFrame:
    """``(index, stored, newest)`` of the folders whose files are all older than ``before`` and
    that the manifest never named: what builds and copies that failed left behind."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(table_path(out, DOCUMENTS)).select("path", "modificationTime"))
    part = lambda key: F.url_decode(F.replace(F.regexp_extract("path", f"/{key}=([^/]*)/", 1), F.lit("+"), F.lit("%2B")))
    folders = (found.select(part("index").alias("index"), part("build_id").alias("stored"), "modificationTime")
               .where("index <> '__HIVE_DEFAULT_PARTITION__'").groupBy("index", "stored").agg(F.max("modificationTime").alias("newest")))
    named = log_rows(spark, read_log(spark, out, whole=True)).select("index", "stored")
    return folders.where(F.col("newest") < F.lit(before)).join(named, ["index", "stored"], "left_anti")


def remove_replaced(spark: SparkSession, out: str, keep: int = 1, unlisted_before: _dt.datetime | None = None) -> int:
    """Remove the files of the removable builds (see ``removable_builds``), and with
    ``unlisted_before`` of unlisted ones; the number of (index, folder) pairs removed.

    The removal is committed to the log before a file goes: a publisher that would roll
    back to such a build at the same time loses the number, reads the log again and copies
    the build anew, into another folder.  A folder goes by one call to the file system.
    Rejected lines stay.  A term dictionary of the folder is brought up to date first, as it
    follows by taking off the counts of replaced builds.
    """
    if has_dictionary(spark, out):
        refresh_terms(spark, out)
    doomed: list[DataFrame] = []

    def rows_at(log: Log) -> DataFrame | None:
        rows = removable_builds(spark, out, keep, log)
        rows = rows.select(*[c if c in ("index", "build_id", "stored") else F.lit(None).cast(t).alias(c)
                             for c, t in ((f.name, f.dataType) for f in T.StructType.fromDDL(SCHEMAS[MANIFEST]).fields)])
        doomed[:] = [_fixed(rows, scratch_path(spark, "removal"))]
        return None if doomed[0].isEmpty() else doomed[0]

    commit(spark, out, rows_at, REMOVED)
    pairs = doomed[0].select("index", "stored")
    if unlisted_before is not None:
        pairs = pairs.unionByName(_fixed(unlisted_builds(spark, out, unlisted_before).select("index", "stored"), scratch_path(spark, "removal")))
    n = 0
    with ThreadPoolExecutor(8) as pool:
        folders: dict[str, dict[str, list[str]]] = {}
        work = []
        for index, stored in pairs.orderBy("stored", "index").toLocalIterator():
            if stored not in folders:
                folders.clear()
                folders[stored] = {name: files.names(spark, build_path(out, name, stored)) for name in TABLES}
            for name, there in folders[stored].items():
                work += [pool.submit(files.delete, spark, f"{build_path(out, name, stored)}/{d}") for d in there if unquote(d) == f"index={index}"]
            n += 1
        for w in work:
            w.result()
    return n


__all__ = ["DOCUMENTS", "MANIFEST", "MAPPING", "POSTINGS", "REJECTED_COLUMNS", "SCHEMAS", "SHARDS", "STATS", "TERMS", "active_documents",
           "active_table", "build_path", "by_index", "claim_build", "colocate", "publish", "read_documents", "read_rejected", "read_table", "read_typed",
           "removable_builds", "remove_replaced", "table_path", "unlisted_builds", "write_documents", "write_index_table"]
