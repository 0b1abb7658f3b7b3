"""Column expressions (all built-in, JVM-side; no Python UDFs)."""

from .hashing import java_hash, java_hash_fold, random_shard, routed_shard, unrouted_shard, use_fold_hash
from .ids import ID_MODES, hash_id, key_id, random_id
from .maps import map_to_str, str_to_map
from .naming import index_name, index_suffix, partition_key
from .text import (field_value, is_blank, null_token, separator_regex, split_escaped,
                   split_escaped_by, unescape)

__all__ = [
    "java_hash", "java_hash_fold", "use_fold_hash", "routed_shard", "unrouted_shard", "random_shard",
    "ID_MODES", "hash_id", "key_id", "random_id",
    "map_to_str", "str_to_map",
    "index_name", "index_suffix", "partition_key",
    "field_value", "is_blank", "null_token", "separator_regex", "split_escaped",
    "split_escaped_by", "unescape",
]
