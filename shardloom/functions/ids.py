"""Document ids.

Every id is the first 128 bits of a SHA-256, written as unpadded URL-safe
base64 (22 characters).  What is hashed depends on the mode:

``position`` (default)
    type + the line's position in the input scan
    (``monotonically_increasing_id`` taken right after the scan, before any
    exchange).  Unique, needs no shuffle and no grouping (so many copies of
    one line cost nothing extra), and equal on a task retry because a scan
    split is re-read in the same order.
``key``
    type + the raw values of the declared unique ``key_fields``:
    content-derived, equal across builds.
``content``
    type + the whole line + its ordinal among equal lines: the ids depend on the
    lines alone, not on files or splits (see ``operators.ordinals``).
``random``
    ``uuid()``, as the source format does; changes on task retry.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ID_MODES = ("position", "key", "content", "random")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_id(*parts) -> Column:
    """The id of a tuple of texts.  Each part is written with its length before
    it (a null as ``-``), so different tuples never give the same text."""
    told = [F.when(_col(p).isNull(), "-").otherwise(F.concat(F.length(_col(p)).cast("string"), F.lit(":"), _col(p))) for p in parts]
    digest = F.sha2(F.concat(*told), 256)
    b64 = F.base64(F.unhex(F.substr(digest, F.lit(1), F.lit(32))))
    return F.rtrim(F.translate(b64, "+/", "-_"), F.lit("="))


def key_id(type_name: str, *raw_key_cols) -> Column:
    return hash_id(F.lit(type_name), *raw_key_cols)


def random_id() -> Column:
    return F.uuid()
