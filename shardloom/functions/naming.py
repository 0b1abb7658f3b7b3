"""Index naming: ``name`` or ``name@v1-v2-...`` from raw partition values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the naming scheme.
PARTITION_INDEX_SEPARATOR = "@"
PARTITION_KEYS_SEPARATOR = "-"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def partition_key(*raw_values) -> Column:
    """Raw values joined with ``-``.  Raw tokens are never null (an empty
    field is ``''`` and ``\\N`` stays two characters), so ``concat_ws``
    drops nothing."""
    return F.concat_ws(PARTITION_KEYS_SEPARATOR, *[_col(v) for v in raw_values])


def index_name(name: str, *raw_values) -> Column:
    if not raw_values:
        return F.lit(name)
    return F.concat(F.lit(name + PARTITION_INDEX_SEPARATOR), partition_key(*raw_values))


def index_suffix(index) -> Column:
    """Text after the first ``@`` of an index name, else null."""
    index = _col(index)
    pos = F.instr(index, PARTITION_INDEX_SEPARATOR)
    return F.when(pos > 0, F.substr(index, pos + 1)).otherwise(F.lit(None).cast("string"))
