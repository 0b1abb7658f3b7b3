"""Names and columns of the tables in an output or live folder."""

from __future__ import annotations

from pyspark.sql import types as T

DOCUMENTS, SHARDS, MAPPING, MANIFEST = "documents", "shards", "mapping", "manifest"
STATS = "_stats"
POSTINGS, TERMS = "postings", "terms"

# Columns of the tables whose layout does not depend on a spec.
SCHEMAS = {
    SHARDS: "shard int, doc_count bigint, is_empty boolean, version int, primary boolean",
    MAPPING: "type string, field string, data_type string, index_mode string, origin string",
    POSTINGS: "shard int, type string, field string, term string, _id string, tf bigint",
    TERMS: "field string, term string, doc_freq bigint, total_freq bigint",
    MANIFEST: "index string, uuid string, num_shards int, replicas int, version int, created_at timestamp, state string, "
              "partition_key string, mappings map<string,string>, doc_count bigint, build_id string, columns string, "
              "publish_seq bigint, action string, stored string",
}
REJECTED_COLUMNS = ("value", "reason")


def ddl(kind: T.DataType) -> str:
    """A type as text, names quoted at every level."""
    if isinstance(kind, T.StructType):
        return "struct<" + ",".join(f"{quoted(f.name)}:{ddl(f.dataType)}" for f in kind.fields) + ">"
    return kind.simpleString()


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def table_path(out: str, name: str) -> str:
    return f"{out.rstrip('/')}/{name}"


def build_path(out: str, name: str, build_id: str) -> str:
    return f"{table_path(out, name)}/build_id={build_id}"


__all__ = ["DOCUMENTS", "SHARDS", "MAPPING", "MANIFEST", "STATS", "POSTINGS", "TERMS", "SCHEMAS", "REJECTED_COLUMNS",
           "ddl", "quoted", "table_path", "build_path"]
