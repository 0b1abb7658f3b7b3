"""shardloom: a Spark-native bulk index builder.

Delimited feeds of one or more document types become sharded, partitioned
index tables (documents, postings, mappings, shard grid, manifests), built
entirely from DataFrame expressions and aggregates.
"""

from .plans.build import BuildResult, build_index
from .spec import FieldMapping, FieldTemplate, IndexSpec, SpecError, TypeSpec

__all__ = ["BuildResult", "build_index", "FieldMapping", "FieldTemplate", "IndexSpec", "SpecError", "TypeSpec"]
