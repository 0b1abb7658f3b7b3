"""Table sinks: document, shard and mapping tables, manifest log, publish, removal."""

from .dictionary import active_terms, refresh_terms
from .documents import (active_documents, active_table, by_index, claim_build, colocate, publish, read_documents, read_rejected,
                        read_table, read_typed, removable_builds, remove_replaced, table_path, unlisted_builds, write_documents,
                        write_index_table)
from .manifest import current_manifest, index_manifest, shard_manifest

__all__ = ["active_documents", "active_table", "active_terms", "refresh_terms", "by_index", "claim_build", "colocate", "publish", "read_documents", "read_rejected",
           "read_table", "read_typed", "removable_builds", "remove_replaced", "table_path", "unlisted_builds", "write_documents",
           "write_index_table", "current_manifest", "index_manifest", "shard_manifest"]
