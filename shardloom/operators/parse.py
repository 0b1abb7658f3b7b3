"""Lines -> records -> documents, in one narrow projection (no exchange).

``parse_lines`` gives one row per input line with its disposition:

* ``dropped``  - the routing field is empty or ``\\N`` (tested on the raw
  token, before the arity check, so a wrong-arity line with a null routing
  key is dropped too; a line too short to *have* the routing field is an
  arity reject);
* ``rejected`` - an empty line, a field count other than the declared one,
  or (with an explicit mapping) a value that does not coerce to its type;
* ``ok``       - a document, with its index, shard and id.

``documents`` then keeps the ``ok`` rows in the document layout
``(index, shard, type, _id, doc, <partition fields>, _present_*)``.  In
``failfast`` mode a rejected line raises inside the same projection; in
``quarantine`` mode it is returned by ``rejected``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import random_shard, routed_shard, unrouted_shard
from ..functions.ids import ID_MODES, hash_id, random_id
from ..functions.naming import index_name
from ..functions.text import field_value, split_escaped
from ..spec import DATA_TYPES, NULL_TOKENS, STRICT_FORMS, IndexSpec, TypeSpec
from .ordinals import with_ordinals

OK, DROPPED, REJECTED = "ok", "dropped", "rejected"
MODES = ("failfast", "quarantine")
# Bits per presence word (a bigint keeps 63 usable bits for a bit-or).
PRESENT_BITS = 63

REASON_EMPTY = "empty_line"
REASON_ARITY = "arity"
REASON_COERCION = "coercion"


def coerces(raw: Column, data_type: str) -> Column:
    """Whether a text is a value of the data type (dates and times by their whole form)."""
    ok = raw.try_cast(DATA_TYPES[data_type]).isNotNull()
    return ok & raw.rlike(STRICT_FORMS[data_type]) if data_type in STRICT_FORMS else ok


def present_columns(tspec: TypeSpec) -> list[str]:
    n = len(tspec.field_names)
    return [f"_present_{j}" for j in range((n + PRESENT_BITS - 1) // PRESENT_BITS)]


def typed_fields(tspec: TypeSpec) -> list[tuple[str, str]]:
    """The fields that the explicit mapping gives a type other than text."""
    return [(name, m.data_type) for name, m in tspec.field_mapping().items() if m.data_type != "string"]


def typed_column_name(tspec: TypeSpec) -> str:
    """The column of a type's typed fields: one struct a type, so a read of one field of
    one type opens that field's column only."""
    return f"_typed_{tspec.name}"


def typed_field_name(name: str, data_type: str) -> str:
    """A typed field's name in that struct: it says the type, so that builds which map a
    field to different types lie side by side."""
    return f"{name}:{data_type}"


def typed_column(tspec: TypeSpec) -> list[Column]:
    """The typed fields of a parsed line as one struct column; none if the mapping types no field."""
    fields = [F.col(n).try_cast(DATA_TYPES[t]).alias(typed_field_name(n, t)) for n, t in typed_fields(tspec)]
    return [F.when(F.col("_status") == OK, F.struct(*fields)).alias(typed_column_name(tspec))] if fields else []


def partition_column(p: str) -> str:
    return f"_p_{p}"


def default_id_mode(tspec: TypeSpec) -> str:
    return "key" if tspec.key_fields else "position"


# --- the rules of a line, as expressions over ``_line``, its split ``_f`` and its number ``_pos`` ---

def _status(t: TypeSpec) -> tuple[Column, Column]:
    """Disposition and reason of a line of the type."""
    f, value, n = F.col("_f"), F.col("_line"), len(t.field_names)
    size, ri = F.size(f), t.routing_index
    none = F.lit(None).cast("string")
    status = F.when(value == "", F.lit(REJECTED))
    reason = F.when(value == "", F.lit(REASON_EMPTY))
    if ri is not None:
        null_routing = (size > ri) & F.get(f, ri).isin(*NULL_TOKENS)
        status = status.when(null_routing, F.lit(DROPPED))
        reason = reason.when(null_routing, none)
    status = status.when(size != n, F.lit(REJECTED))
    reason = reason.when(size != n, F.lit(REASON_ARITY))
    for name, m in t.field_mapping().items():
        if m.data_type != "string":
            raw = _value(t, name)
            bad = raw.isNotNull() & ~coerces(raw, m.data_type)
            status = status.when(bad, F.lit(REJECTED))
            reason = reason.when(bad, F.lit(f"{REASON_COERCION}:{name}"))
    return status.otherwise(F.lit(OK)), reason.otherwise(none)


def _raw(t: TypeSpec, name: str) -> Column:
    return F.get(F.col("_f"), t.index_of(name))


def _value(t: TypeSpec, name: str) -> Column:
    return field_value(_raw(t, name))


def _doc_id(t: TypeSpec, id_mode: str) -> Column:
    if id_mode == "position":
        return hash_id(F.lit(t.name), F.col("_pos").cast("string"))
    if id_mode == "content":
        return hash_id(F.lit(t.name), F.col("_line"), F.col("_pos").cast("string"))
    if id_mode == "random":
        return random_id()
    if not t.key_fields:
        raise ValueError(f"id_mode='key' needs key_fields on type {t.name!r}")
    return hash_id(F.lit(t.name), *[_raw(t, k) for k in t.key_fields])


def _shard(t: TypeSpec, ispec: IndexSpec) -> Column:
    """From the raw routing token, or from ``_id``."""
    if t.routing_field is not None:
        return routed_shard(_raw(t, t.routing_field), ispec.num_shards)
    return random_shard(ispec.num_shards) if ispec.unrouted == "random" else unrouted_shard(F.col("_id"), ispec.num_shards)


def _index(t: TypeSpec, ispec: IndexSpec) -> Column:
    return index_name(ispec.name, *[_raw(t, p) for p in ispec.partition_fields or ()])


def _presence(t: TypeSpec, value=None) -> list[Column]:
    """The presence words; ``value`` gives the column of a field (by default its own)."""
    value, words = value or F.col, []
    for j, wname in enumerate(present_columns(t)):
        chunk = t.field_names[j * PRESENT_BITS:(j + 1) * PRESENT_BITS]
        bits = [F.when(value(c).isNotNull(), F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint") for k, c in enumerate(chunk)]
        words.append(reduce(lambda a, b: a + b, bits).alias(wname))
    return words


def _id_mode(t: TypeSpec, id_mode: str | None) -> str:
    id_mode = id_mode or default_id_mode(t)
    if id_mode not in ID_MODES:
        raise ValueError(f"unknown id_mode {id_mode!r}")
    return id_mode


def parse_lines(lines: DataFrame, tspec: TypeSpec, ispec: IndexSpec, *,
                id_mode: str | None = None, value_col: str = "value") -> DataFrame:
    """One row per line: ``_type, _line, _status, _reason`` + normalised fields +
    raw partition values (``_p_<field>``) + ``_index, _shard, _id`` + presence
    words.  Bookkeeping columns start with ``_``; field names may not.

    ``lines`` must come straight from a scan (no exchange in between) when
    ``id_mode`` is ``position`` (the id is the line's position in its scan
    split) or ``content`` (copies of a line are counted per split).
    """
    id_mode = _id_mode(tspec, id_mode)
    names = tspec.field_names
    cols = [F.lit(tspec.name).alias("_type"), F.col(value_col).cast("string").alias("_line")]
    numbered = id_mode in ("position", "content")
    if id_mode == "position":
        cols.append(F.monotonically_increasing_id().alias("_pos"))
    elif id_mode == "content":
        lines = with_ordinals(lines.select(value_col), value_col, name="_pos")
        cols.append(F.col("_pos"))
    # the split is computed once a line; all else is plain projection over it,
    # so a query that needs only index and shard makes no ids and no fields
    df = compute_once(lines.select(*cols).withColumn("_f", split_escaped("_line", tspec.field_sep)))

    status, reason = _status(tspec)
    field_cols = [_value(tspec, name).alias(name) for name in names]
    pf = list(ispec.partition_fields or ())
    part_cols = [_raw(tspec, p).alias(partition_column(p)) for p in pf]
    keep = ["_line"] + ["_pos"] * numbered
    df = df.select("_type", *keep, status.alias("_status"),
                   reason.alias("_reason"), "_f", *field_cols, *part_cols)
    ok = F.col("_status") == OK
    df = df.withColumn("_id", F.when(ok, _doc_id(tspec, id_mode)))
    index = index_name(ispec.name, *[F.col(partition_column(p)) for p in pf])
    df = df.withColumn("_index", F.when(ok, index)).withColumn("_shard", F.when(ok, _shard(tspec, ispec)))
    return df.select("_type", "_line", "_status", "_reason", *names,
                     *[partition_column(p) for p in pf], "_index", "_shard", "_id", *_presence(tspec))


def build_tagged_rows(tagged: DataFrame, ispec: IndexSpec, *, mode: str = "failfast", id_mode: str | None = None) -> DataFrame:
    """``build_rows`` of lines of several types in one pass: ``tagged(type, value)`` from one
    scan, every rule a branch of literals for the line's type.  The columns are those of
    the types' own rows, null for the other types."""
    modes = {t.name: _id_mode(t, id_mode) for t in ispec.types}
    cols = [F.col("type").alias("_type"), F.col("value").cast("string").alias("_line")]
    if "content" in modes.values():
        tagged = with_ordinals(tagged.select("type", "value"), "type", "value", name="_pos")
        cols.append(F.col("_pos"))
    elif "position" in modes.values():
        cols.append(F.monotonically_increasing_id().alias("_pos"))

    def by_type(make, types=ispec.types) -> Column:
        out = F
        for t in types:
            out = out.when(F.col("_type") == t.name, make(t))
        return out

    df = compute_once(tagged.select(*cols).withColumn("_f", by_type(lambda t: split_escaped("_line", t.field_sep))))
    df = df.withColumns({"_status": by_type(lambda t: _status(t)[0]), "_reason": by_type(lambda t: _status(t)[1])})
    ok = F.col("_status") == OK
    df = df.withColumn("_id", F.when(ok, by_type(lambda t: _doc_id(t, modes[t.name]))))
    df = compute_once(df)
    is_rej = F.col("_status") == REJECTED
    keep = ok | is_rej if mode == "quarantine" else _fail_on_reject(mode)
    doc = by_type(lambda t: F.to_json(F.struct(*[_value(t, n).alias(n) for n in t.field_names], F.col("_id"))))
    widest = max((present_columns(t) for t in ispec.types), key=len)
    words = [by_type(lambda t, w=w: next((c for c, n in zip(_presence(t, lambda f: _value(t, f)), present_columns(t)) if n == w), F.lit(None).cast("bigint"))).alias(w)
             for w in widest]
    typed = []
    for t in ispec.types:
        fields = [_value(t, n).try_cast(DATA_TYPES[d]).alias(typed_field_name(n, d)) for n, d in typed_fields(t)]
        typed += [F.when(ok & (F.col("_type") == t.name), F.struct(*fields)).alias(typed_column_name(t))] if fields else []
    return df.filter(keep).select(
        F.when(ok, by_type(lambda t: _index(t, ispec))).alias("index"), F.when(ok, by_type(lambda t: _shard(t, ispec))).alias("shard"),
        F.col("_type").alias("type"), "_id", F.when(ok, doc).alias("doc"),
        *[by_type(lambda t, p=p: _raw(t, p)).alias(p) for p in ispec.partition_fields or ()], *words, *typed,
        F.when(is_rej, F.col("_line")).alias("value"), F.when(is_rej, F.col("_reason")).alias("reason"))


def compute_once(df: DataFrame) -> DataFrame:
    """Stop later filters on ``_status`` from being pushed below the parse
    (and later lambdas from re-evaluating an expression per array element).

    Pushing a filter through a projection inlines the aliases, so the split
    (a regex over the whole line) would run again for every reference in the
    status expression.  A one-row generator keeps every column computed once:
    predicates on generator output are not pushed below it.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def _fail_on_reject(mode: str) -> Column:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    st = F.col("_status")
    if mode == "quarantine":
        return st == OK
    return (F.when(st == OK, F.lit(True))
            .when(st == DROPPED, F.lit(False))
            .otherwise(F.raise_error(F.concat(F.lit("rejected line ("), F.col("_reason"),
                                              F.lit("), type "), F.col("_type"),
                                              F.lit(": "), F.col("_line"))).cast("boolean")))


def documents(parsed: DataFrame, tspec: TypeSpec, ispec: IndexSpec, *,
              mode: str = "failfast") -> DataFrame:
    """``ok`` rows as documents: JSON of the non-null fields, ``_id`` last."""
    doc = F.to_json(F.struct(*[F.col(c) for c in tspec.field_names], F.col("_id")))
    pf = list(ispec.partition_fields or ())
    return (parsed.filter(_fail_on_reject(mode))
            .select(F.col("_index").alias("index"), F.col("_shard").alias("shard"),
                    F.col("_type").alias("type"), "_id", doc.alias("doc"),
                    *[F.col(partition_column(p)).alias(p) for p in pf],
                    *present_columns(tspec)))


def records(parsed: DataFrame, tspec: TypeSpec, *, mode: str = "failfast") -> DataFrame:
    """``ok`` rows with their fields as columns (for mapping, postings, typing).

    The document's own columns keep the ``_`` prefix (``_index, _shard,
    _type, _id``) so that no field name can collide with them."""
    return (parsed.filter(_fail_on_reject(mode))
            .select("_index", "_shard", "_type", "_id", *tspec.field_names, *present_columns(tspec)))


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("_status") == REJECTED).select(
        F.col("_type").alias("type"), F.col("_line").alias("value"), F.col("_reason").alias("reason"))


def split_fields(lines: DataFrame, sep: str, value_col: str = "value") -> DataFrame:
    """P1 on its own: ``(value, pos, field)`` for every field of every line."""
    return lines.select(F.col(value_col).alias("value"),
                        F.posexplode(split_escaped(value_col, sep)).alias("pos", "field"))


def project_fields(lines: DataFrame, tspec: TypeSpec, value_col: str = "value") -> DataFrame:
    """Raw tokens named by position, for lines of the declared arity."""
    f = split_escaped(value_col, tspec.field_sep)
    df = lines.select(F.col(value_col).alias("value"), f.alias("_f"))
    df = df.filter((F.size("_f") == len(tspec.field_names)) & (F.col("value") != ""))
    return df.select("value", *[F.get("_f", i).alias(n) for i, n in enumerate(tspec.field_names)])


def strip_id(doc) -> Column:
    """Text form of the ``_id`` strip: drop ``,"_id":"..."`` from a document."""
    doc = F.col(doc) if isinstance(doc, str) else doc
    return F.regexp_replace(doc, ',"_id":".*"', "")


def parse_types(inputs: dict[str, DataFrame], ispec: IndexSpec, *, mode: str = "failfast",
                id_mode: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Every type to the common document layout, then ``unionByName``.

    Returns ``(documents, rejected)``.  Each type keeps its own separator,
    fields and routing as literals in its branch of the plan.
    """
    docs, rejs = [], []
    for t in ispec.types:
        parsed = parse_lines(inputs[t.name], t, ispec, id_mode=id_mode)
        docs.append(documents(parsed, t, ispec, mode=mode))
        rejs.append(rejected(parsed))
    out_docs, out_rej = docs[0], rejs[0]
    for d in docs[1:]:
        out_docs = out_docs.unionByName(d, allowMissingColumns=True)
    for r in rejs[1:]:
        out_rej = out_rej.unionByName(r)
    return out_docs, out_rej


def build_rows(parsed: DataFrame, tspec: TypeSpec, ispec: IndexSpec, *,
               mode: str = "failfast", build_id: str | None = None) -> DataFrame:
    """Documents and (in quarantine mode) rejected lines in one frame, so one
    pass over the input writes both: a rejected line has a null ``index``
    and carries its raw ``value`` and ``reason``; a document has both null.
    Fields that the mapping gives a type stand in a struct column of their type
    as well (L1); the document text holds them as they were written.
    ``build_id`` stamps every row, so what one build wrote can be read back
    by a pushed-down filter (row-group statistics skip older files)."""
    doc = F.to_json(F.struct(*[F.col(c) for c in tspec.field_names], F.col("_id")))
    pf = list(ispec.partition_fields or ())
    st = F.col("_status")
    keep = (st == OK) | (st == REJECTED) if mode == "quarantine" else _fail_on_reject(mode)
    is_rej = st == REJECTED
    stamp = [F.lit(build_id).alias("build_id")] if build_id is not None else []
    return (parsed.filter(keep)
            .select(F.col("_index").alias("index"), F.col("_shard").alias("shard"),
                    F.col("_type").alias("type"), "_id", F.when(~is_rej, doc).alias("doc"),
                    *[F.col(partition_column(p)).alias(p) for p in pf],
                    *present_columns(tspec), *typed_column(tspec),
                    F.when(is_rej, F.col("_line")).alias("value"),
                    F.when(is_rej, F.col("_reason")).alias("reason"), *stamp))
