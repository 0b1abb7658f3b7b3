"""Delimited line sources.

* ``read_lines``  - S1: Spark's text source; any record delimiter, gzip/bzip2
  chosen by file extension (bzip2 and uncompressed input are splittable).
* ``read_typed``  - S2: one shared scan over many type folders; each line is
  tagged with its type from its file path (exact file first, then its direct
  parent folder) by a broadcast join against the small ``(path, type)``
  table built from the spec; an untagged file fails the job.
* ``filter_long_lines`` - S3: keep a line only if its bytes plus its
  delimiter are under the limit.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import IndexSpec

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?"


def read_lines(spark: SparkSession, paths: str | Iterable[str], line_sep: str | None = None) -> DataFrame:
    reader = spark.read
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    if isinstance(paths, str):
        paths = [paths]
    return reader.text(list(paths))


def write_lines(lines: DataFrame, path: str, *, line_sep: str | None = None,
                compression: str | None = None, value_col: str = "value") -> None:
    w = lines.select(F.col(value_col).alias("value")).write.mode("overwrite")
    if line_sep is not None:
        w = w.option("lineSep", line_sep)
    if compression is not None:
        w = w.option("compression", compression)
    w.text(path)


def bare_path(c) -> F.Column:
    """A path without scheme and authority, and without a trailing ``/``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.regexp_replace(c, _SCHEME, ""), "/+$", "")


def _bare(p: str) -> str:
    import re
    return re.sub(r"/+$", "", re.sub(_SCHEME, "", p))


def read_typed(spark: SparkSession, type_paths: dict[str, str], line_sep: str | None = None) -> DataFrame:
    """``(type, value)`` from one scan over every type's input path."""
    lines = read_lines(spark, list(type_paths.values()), line_sep)
    lines = lines.select("value", bare_path(F.col("_metadata.file_path")).alias("_file"))
    lines = lines.withColumn("_dir", F.regexp_replace("_file", "/[^/]*$", ""))
    # one row per declared path: bounded by the spec, so broadcasting is safe
    tags = spark.createDataFrame([(_bare(p), t) for t, p in type_paths.items()], "path string, type string")
    by_file = F.broadcast(tags.select(F.col("path").alias("_file"), F.col("type").alias("_t_file")))
    by_dir = F.broadcast(tags.select(F.col("path").alias("_dir"), F.col("type").alias("_t_dir")))
    tagged = lines.join(by_file, "_file", "left").join(by_dir, "_dir", "left")
    t = F.coalesce("_t_file", "_t_dir")
    return tagged.select(
        F.when(t.isNull(), F.raise_error(F.concat(F.lit("no type is registered for "), F.col("_file"))))
        .otherwise(t).alias("type"),
        "value")


def shared_scan(ispec: IndexSpec) -> bool:
    """Whether one scan can read every type: several types, one record delimiter, and paths
    that tell them apart (no patterns, none twice)."""
    paths = [t.input_path for t in ispec.types]
    return (len(paths) > 1 and None not in paths and len({_bare(p) for p in paths}) == len(paths)
            and len({t.record_sep for t in ispec.types}) == 1 and not any(set(p) & set("*?[{") for p in paths))


def read_index_lines(spark: SparkSession, ispec: IndexSpec, line_sep: str | None = None) -> DataFrame:
    """``(type, value)`` of every type's lines from one scan, whose tasks are packed by
    size across the types; over-long lines left out by their type's limit."""
    sep = ispec.types[0].record_sep if ispec.types[0].record_sep is not None else line_sep
    tagged = read_typed(spark, {t.name: t.input_path for t in ispec.types}, sep)
    for t in ispec.types:
        if t.max_line_bytes is not None:
            room = F.octet_length("value") + F.lit(len((sep or "\n").encode("utf-8"))) < F.lit(t.max_line_bytes)
            tagged = tagged.filter((F.col("type") != t.name) | room)
    return tagged


def read_index_inputs(spark: SparkSession, ispec: IndexSpec, line_sep: str | None = None) -> dict[str, DataFrame]:
    """One scan per type (its separator and fields are literals in its branch)."""
    out = {}
    for t in ispec.types:
        if t.input_path is None:
            raise ValueError(f"type {t.name!r} has no input_path")
        sep = t.record_sep if t.record_sep is not None else line_sep
        out[t.name] = filter_long_lines(read_lines(spark, t.input_path, sep), t.max_line_bytes, sep or "\n")
    return out


def filter_long_lines(lines: DataFrame, max_bytes: int | None, line_sep: str = "\n",
                      value_col: str = "value") -> DataFrame:
    if max_bytes is None:
        return lines
    sep_bytes = len(line_sep.encode("utf-8"))
    return lines.filter(F.octet_length(value_col) + F.lit(sep_bytes) < F.lit(max_bytes))
