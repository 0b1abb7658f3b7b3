"""Field mappings: inferred from the documents, merged with explicit ones.

Inference is exact (every document counts, not a sample): each document
carries presence words (bit ``i`` set when field ``i`` is non-null), and one
partial + final aggregate ORs them per (index, type).  The words are decoded
against the spec's field list, a table bounded by the number of declared
fields, so broadcasting it is safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import DATA_TYPES, FieldMapping, IndexSpec, TypeSpec
from .parse import PRESENT_BITS, present_columns


def all_present_columns(ispec: IndexSpec) -> list[str]:
    return max((present_columns(t) for t in ispec.types), key=len)


def presence_stats(docs: DataFrame, ispec: IndexSpec) -> DataFrame:
    """``(index, shard, type, doc_count, _present_*)``: one small aggregate
    from which counts, the shard grid and the mapping all follow."""
    words = [w for w in all_present_columns(ispec) if w in docs.columns]
    return docs.groupBy("index", "shard", "type").agg(
        F.count(F.lit(1)).alias("doc_count"), *[F.bit_or(w).alias(w) for w in words])


def field_positions(spark: SparkSession, ispec: IndexSpec) -> DataFrame:
    rows = [(t.name, name, i // PRESENT_BITS, 1 << (i % PRESENT_BITS))
            for t in ispec.types for i, name in enumerate(t.field_names)]
    return spark.createDataFrame(rows, "type string, field string, word int, mask bigint")


def _per_type(stats_or_docs: DataFrame, ispec: IndexSpec) -> DataFrame:
    words = [w for w in all_present_columns(ispec) if w in stats_or_docs.columns]
    return stats_or_docs.groupBy("index", "type").agg(*[F.bit_or(w).alias(w) for w in words])


def _decode(per_type: DataFrame, ispec: IndexSpec) -> DataFrame:
    spark = per_type.sparkSession
    words = [c for c in per_type.columns if c.startswith("_present_")]
    pos = F.broadcast(field_positions(spark, ispec))
    word = F.element_at(F.array(*[F.col(w) for w in words]), F.col("word") + 1)
    return (per_type.join(pos, "type")
            .filter(word.bitwiseAND(F.col("mask")) != 0)
            .select("index", "type", "field"))


def infer_mapping(stats_or_docs: DataFrame, ispec: IndexSpec) -> DataFrame:
    """``(index, type, field)`` for every field with a non-null value."""
    return _decode(_per_type(stats_or_docs, ispec), ispec)


def field_table(spark: SparkSession, ispec: IndexSpec) -> DataFrame:
    """Every declared field: its presence bit, its mapping and where that comes
    from (stated, from the first template that fits, or the default).  Built from the spec, so its size is the number of declared fields."""
    rows = []
    for t in ispec.types:
        told, explicit = t.field_mapping(), t.explicit_mapping()
        for i, name in enumerate(t.field_names):
            m = told.get(name, FieldMapping(name))
            origin = "explicit" if name in explicit else "template" if name in told else "inferred"
            rows.append((t.name, name, i // PRESENT_BITS, 1 << (i % PRESENT_BITS), m.data_type, m.index_mode, origin))
    return spark.createDataFrame(
        rows, "type string, field string, word int, mask bigint, data_type string, index_mode string, origin string")


def merge_mapping(stats_or_docs: DataFrame, ispec: IndexSpec) -> DataFrame:
    """Explicit properties win; every other seen field is what the first
    fitting template says, else a ``string``/``not_analyzed`` keyword; only types that have documents in
    the index get a mapping there (explicit fields included even if unseen).

    One aggregate (presence words per index and type) and one broadcast join
    with the spec's field table.
    """
    spark = stats_or_docs.sparkSession
    per_type = _per_type(stats_or_docs, ispec)
    words = [c for c in per_type.columns if c.startswith("_present_")]
    word = F.element_at(F.array(*[F.col(w) for w in words]), F.col("word") + 1)
    seen = word.bitwiseAND(F.col("mask")) != 0
    m = per_type.join(F.broadcast(field_table(spark, ispec)), "type") \
        .filter(seen | (F.col("origin") == "explicit"))
    return m.select("index", "type", "field", "data_type", "index_mode", "origin")


def mapping_json(mapping: DataFrame) -> DataFrame:
    """Per (index, type) the mapping as JSON text, fields in name order."""
    prop = F.concat(F.lit('"'), F.col("field"), F.lit('":{"type":"'), F.col("data_type"),
                    F.lit('","index":"'), F.col("index_mode"), F.lit('"}'))
    entries = F.sort_array(F.collect_list(F.struct(F.col("field"), prop.alias("p"))))
    return mapping.groupBy("index", "type").agg(
        F.concat(F.lit('{"properties":{'), F.array_join(F.transform(entries, lambda e: e["p"]), ","),
                 F.lit("}}")).alias("mapping"))


def typed_records(recs: DataFrame, tspec: TypeSpec) -> DataFrame:
    """L1: fields coerced by the explicit mapping (ANSI ``cast``: a value that
    slipped past the coercion check fails the job)."""
    explicit = tspec.field_mapping()
    cols = []
    for name in tspec.field_names:
        m = explicit.get(name)
        if m is None or m.data_type == "string":
            cols.append(F.col(name))
        else:
            cols.append(F.col(name).cast(DATA_TYPES[m.data_type]).alias(name))
    return recs.select("_index", "_shard", "_type", "_id", *cols)
