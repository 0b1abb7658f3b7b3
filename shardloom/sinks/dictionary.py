"""The term dictionary of a live folder, kept current over publications (L4).

``(field, term, doc_freq, total_freq)`` over the documents of all current indices::

    dictionary/versions/<number>     names the rows of the dictionary as of publication <number>
    dictionary/rows/<id>/            its rows

A publication replaces a few indices of many.  The dictionary follows by adding the counts
of the builds that came in and taking off those of the builds that went out, which their
``terms`` tables hold; the tables of indices that stayed are not read, and no posting is.
The first version is made of all current builds.  A version is named only once (see
``files.put_if_absent``); of two that make the same version one is dropped.
"""

from __future__ import annotations

import uuid as _uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import build_conf
from . import files
from .layout import SCHEMAS, TERMS, table_path
from .manifest import current_manifest, read_log

DICTIONARY = "dictionary"
SCHEMA = "field string, term string, doc_freq bigint, total_freq bigint"


def _versions(spark: SparkSession, out: str) -> list[int]:
    return [int(n) for n in files.names(spark, f"{table_path(out, DICTIONARY)}/versions") if n.isdigit()]


def _read(spark: SparkSession, out: str, number: int) -> DataFrame:
    at = table_path(out, DICTIONARY)
    return spark.read.schema(SCHEMA).parquet(f"{at}/rows/{files.read_text(spark, f'{at}/versions/{number:012d}').strip()}")


def changed_builds(spark: SparkSession, out: str, since: int, to: int) -> DataFrame:
    """``(index, build_id, sign)``: the folders that became current (1) and that ceased to be
    (-1) between the states as of two publication numbers."""
    now = current_manifest(spark, out, to).select("index", F.col("stored").alias("build_id"))
    if not since:
        return now.withColumn("sign", F.lit(1))
    before = current_manifest(spark, out, since).select("index", F.col("stored").alias("build_id"))
    came = now.join(before, ["index", "build_id"], "left_anti").withColumn("sign", F.lit(1))
    return came.unionByName(before.join(now, ["index", "build_id"], "left_anti").withColumn("sign", F.lit(-1)))


def merged_terms(spark: SparkSession, out: str, since: int, to: int) -> DataFrame:
    """The dictionary as of ``to``, from that of ``since`` (0: none) and the changed builds."""
    terms = spark.read.schema(f"{SCHEMAS[TERMS]}, build_id string, index string").parquet(table_path(out, TERMS))
    # the changed builds choose the folders that are read (dynamic partition pruning)
    changes = terms.join(F.broadcast(changed_builds(spark, out, since, to)), ["index", "build_id"])
    rows = changes.select("field", "term", *[(F.col(c) * F.col("sign")).alias(c) for c in ("doc_freq", "total_freq")])
    if since:
        rows = _read(spark, out, since).unionByName(rows)
    merged = rows.groupBy("field", "term").agg(F.sum("doc_freq").alias("doc_freq"), F.sum("total_freq").alias("total_freq"))
    return merged.where("doc_freq > 0")


def refresh_terms(spark: SparkSession, out: str) -> int:
    """Bring the dictionary of a live folder to its last publication; that number.

    The builds must have been made with ``postings=True``: an index without terms
    has no entries.
    """
    last = read_log(spark, out).last
    since = max((n for n in _versions(spark, out) if n <= last), default=0)
    if last and since < last:
        name, at = _uuid.uuid4().hex, table_path(out, DICTIONARY)
        with build_conf(spark):
            merged_terms(spark, out, since, last).sortWithinPartitions("field", "term").write.parquet(f"{at}/rows/{name}")
        if not files.put_if_absent(spark, f"{at}/versions/{last:012d}", name):
            files.delete(spark, f"{at}/rows/{name}")
    return last


def active_terms(spark: SparkSession, out: str) -> DataFrame:
    """The dictionary of all current indices, brought up to date first."""
    last = refresh_terms(spark, out)
    return _read(spark, out, last) if last else spark.createDataFrame([], SCHEMA)


def has_dictionary(spark: SparkSession, out: str) -> bool:
    return bool(_versions(spark, out))


__all__ = ["active_terms", "changed_builds", "has_dictionary", "merged_terms", "refresh_terms"]
