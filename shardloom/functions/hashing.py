"""Routing: Java ``String.hashCode`` as a column and the shard rule built on it.

``String.hashCode`` folds the UTF-16 code units of a string with
``h = 31 * h + unit`` in 32-bit two's complement.  Spark's ``hash`` is Murmur3,
so it cannot be used.  Two exact forms are given:

* ``java_hash`` (default) asks the JVM for the hash itself through Spark's
  public ``reflect`` function (``java.util.Objects.hashCode`` of the string):
  one call per row, about 20x cheaper than the fold.  Catalyst marks
  ``reflect`` non-deterministic, so it is only ever placed in a projection.
* ``java_hash_fold`` writes the fold with built-in higher-order functions
  (``aggregate`` over the characters), for sessions that do not allow
  reflection.  Surrogate pairs are two units, exactly as in Java.

Both forms sit outside whole-stage codegen (a ``reflect`` call and lambdas
are evaluated per row), so callers compute the hash once, on the routing
column only, before any exchange.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MASK32 = 0xFFFFFFFF
_TWO_31 = 1 << 31
_TWO_32 = 1 << 32


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


_USE_FOLD = False


def use_fold_hash(enabled: bool = True) -> None:
    """Route with :func:`java_hash_fold` (for sessions where ``reflect`` is
    not allowed).  Both forms give the same value for every string."""
    global _USE_FOLD
    _USE_FOLD = bool(enabled)


def java_hash(s) -> Column:
    """``String.hashCode`` of a string column, as ``int`` (null stays null),
    computed by the JVM (``reflect`` returns the value as text)."""
    if _USE_FOLD:
        return java_hash_fold(s)
    s = _col(s)
    h = F.reflect(F.lit("java.util.Objects"), F.lit("hashCode"), s).cast("int")
    return F.when(s.isNotNull(), h)


def java_hash_fold(s) -> Column:
    """``String.hashCode`` of a string column, as ``int`` (null stays null),
    written with built-in expressions only.

    Characters are taken with ``(?s).`` (a surrogate pair is one match) and
    their code points with ``ascii``; a code point above U+FFFF is folded as
    its two UTF-16 units.  The fold is referenced once, so it runs once.
    """
    s = _col(s)
    cps = F.transform(F.regexp_extract_all(s, F.lit("(?s)."), 0), lambda c: F.ascii(c).cast("bigint"))
    mask = F.lit(_MASK32)

    def step(acc, cp):
        off = cp - 0x10000
        hi = F.lit(0xD800) + F.shiftright(off, 10)
        lo = F.lit(0xDC00) + off.bitwiseAND(F.lit(0x3FF))
        pair = ((acc * 31 + hi).bitwiseAND(mask) * 31 + lo).bitwiseAND(mask)
        return F.when(cp > 0xFFFF, pair).otherwise((acc * 31 + cp).bitwiseAND(mask))

    folded = F.aggregate(cps, F.lit(0).cast("bigint"), step)
    # unsigned 32-bit -> signed, with the fold referenced once
    return (F.pmod(folded + _TWO_31, F.lit(_TWO_32)) - _TWO_31).cast("int")


def routed_shard(raw_routing, num_shards: int) -> Column:
    """``abs(hash % n)``: remainder first (sign of the dividend), then abs.

    This is not ``pmod``; the two differ for every negative hash that is not
    a multiple of ``n``.
    """
    return F.abs(java_hash(raw_routing) % F.lit(num_shards)).cast("int")


def unrouted_shard(doc_id, num_shards: int) -> Column:
    """Shard of a document without a routing field: its id is the routing
    key (the same ``abs(hash % n)`` rule), so a retried task puts every
    document where the first attempt did.  Ids are short, so the fold is cheap."""
    return routed_shard(doc_id, num_shards)


def random_shard(num_shards: int, seed: int | None = None) -> Column:
    """Random placement, as the source format does; differs on task retry."""
    r = F.rand(seed) if seed is not None else F.rand()
    return F.floor(r * num_shards).cast("int")
