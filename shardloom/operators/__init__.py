"""DataFrame operators of the build (parse, route, aggregate, join, index content)."""

from .aggregates import distinct_shards, index_shards, sample_per_type, shard_counts, shard_stats
from .grid import empty_shards, shard_grid
from .lookup import publish_plan, type_lookup, type_table
from .duplicates import DuplicateIds, duplicate_ids
from .mapping import infer_mapping, mapping_json, merge_mapping, presence_stats, typed_records
from .ordinals import with_ordinals
from .parse import (build_rows, documents, parse_lines, parse_types, project_fields, records,
                    rejected, split_fields, strip_id)
from .postings import keyword_postings, term_stats, text_postings

__all__ = [
    "distinct_shards", "index_shards", "sample_per_type", "shard_counts", "shard_stats",
    "empty_shards", "shard_grid", "publish_plan", "type_lookup", "type_table",
    "DuplicateIds", "duplicate_ids", "with_ordinals", "infer_mapping", "mapping_json", "merge_mapping", "presence_stats",
    "typed_records", "build_rows", "documents", "parse_lines", "parse_types", "project_fields",
    "records", "rejected", "split_fields", "strip_id", "keyword_postings", "term_stats",
    "text_postings",
]
