"""Helpers for tables of vectors."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

WHOLE = pa.list_(pa.decimal128(38, 0))       # exact sums; Spark adds them as decimal(38,0)


def finite(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~bad


def common_length(vectors: DataFrame, vector: str) -> int | None:
    """The most frequent length of the vectors (the smallest of equally frequent ones)."""
    n = vectors.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").first()
    return None if n is None else n.d


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The rows of a list column of equal lengths, in double precision."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def whole_numbers(values) -> pa.Array:
    """One list of whole numbers, exact."""
    return pa.array([[Decimal(int(v)) for v in values]], WHOLE)


def total_by_position(partials: DataFrame, column: str) -> list[int]:
    """Position-wise sums of the lists of ``partials``: as many numbers as one list holds."""
    got = (partials.where(F.col(column).isNotNull()).select(F.posexplode(column).alias("at", "v"))
           .groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect())
    return [int(r.v) for r in got]


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` under the shared scratch folder; the table read back, and its path."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


__all__ = ["WHOLE", "finite", "common_length", "matrix", "whole_numbers", "total_by_position", "written", "remove"]
