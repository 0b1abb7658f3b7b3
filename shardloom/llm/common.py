"""Helpers the operators share: scratch tables and the word pattern."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch_path

# A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared scratch folder and read it back.

    Cuts the lineage: later steps read files that every executor reaches, so
    a lost executor costs only the tasks it ran.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


__all__ = ["WORD", "saved", "read_table"]
