"""Independent SQL statements of the same rules, for DuckDB.

Used only to check the Spark plans: every registered query has its result
restated here in plain SQL over the same parquet tables.  DuckDB has no
look-behind, so the escape-aware split swaps each escaped separator for a
placeholder, splits, and restores it; the Java hash folds the UTF-16 units
of each character with ``list_reduce``.
"""

from __future__ import annotations

from ..spec import DATA_TYPES, IndexSpec, TypeSpec

# Placeholder for an escaped separator during the split (a noncharacter).
_PH = "chr(1114109)"
_DUCK_TYPES = {"string": "VARCHAR", "byte": "TINYINT", "short": "SMALLINT", "integer": "INTEGER",
               "long": "BIGINT", "float": "FLOAT", "double": "DOUBLE", "boolean": "BOOLEAN",
               "date": "DATE", "timestamp": "TIMESTAMPTZ"}
# The whole form of a date and of a time, stated apart from the spec.
_DUCK_FORMS = {"date": "[0-9]{4}-[0-9]{2}-[0-9]{2}",
               "timestamp": "[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?(Z|[+-][0-9]{2}:[0-9]{2})?"}
assert set(_DUCK_TYPES) == set(DATA_TYPES)


def lit(s: str) -> str:
    """A DuckDB string expression for ``s`` (control characters via chr)."""
    parts, buf = [], ""
    for ch in s:
        if ord(ch) < 32:
            if buf:
                parts.append("'" + buf.replace("'", "''") + "'")
                buf = ""
            parts.append(f"chr({ord(ch)})")
        else:
            buf += ch
    if buf or not parts:
        parts.append("'" + buf.replace("'", "''") + "'")
    return " || ".join(parts) if len(parts) > 1 else parts[0]


def split_sql(value: str, sep: str) -> str:
    esc = lit("\\" + sep)
    return (f"list_transform(string_split(replace({value}, {esc}, {_PH}), {lit(sep)}), "
            f"lambda x: replace(x, {_PH}, {esc}))")


def null_token_sql(raw: str) -> str:
    return f"(CASE WHEN {raw} IN ('', '\\N') THEN NULL ELSE {raw} END)"


def field_value_sql(raw: str) -> str:
    return (f"(CASE WHEN {raw} IN ('', '\\N') THEN NULL "
            f"WHEN instr({raw}, '\\') > 1 THEN replace({raw}, '\\', '') ELSE {raw} END)")


def java_hash_sql(s: str) -> str:
    fold = ("list_reduce(list_transform(string_split({s}, ''), lambda c: unicode(c)), "
            "lambda a, x: CASE WHEN x > 65535 THEN "
            "((((a * 31 + (55296 + ((x - 65536) >> 10))) & 4294967295) * 31) "
            "+ (56320 + ((x - 65536) & 1023))) & 4294967295 "
            "ELSE (a * 31 + x) & 4294967295 END, 0::BIGINT)").format(s=s)
    return (f"(CASE WHEN {s} IS NULL THEN NULL WHEN {s} = '' THEN 0 ELSE "
            f"(({fold} + 2147483648) % 4294967296) - 2147483648 END)::INTEGER")


def routed_shard_sql(raw: str, n: int) -> str:
    return f"abs({java_hash_sql(raw)} % {n})::INTEGER"


def hash_id_sql(*parts: str) -> str:
    told = [f"CASE WHEN {p} IS NULL THEN '-' ELSE length({p}) || ':' || {p} END" for p in parts]
    joined = f"concat({', '.join(told)})"
    return (f"rtrim(translate(to_base64(unhex(substr(sha256({joined}), 1, 32))), '+/', '-_'), '=')")


def json_doc_sql(names: list[str], with_id: str | None) -> str:
    """The document text: non-null fields in order, all strings, ``_id`` last."""
    items = [f"CASE WHEN {n} IS NOT NULL THEN '\"{n}\":' || CAST(to_json({n}) AS VARCHAR) END" for n in names]
    if with_id is not None:
        items.append(f"'\"_id\":' || CAST(to_json({with_id}) AS VARCHAR)")
    return f"('{{' || array_to_string(list_filter([{', '.join(items)}], lambda x: x IS NOT NULL), ',') || '}}')"


# Marker put before a joiner that stays inside a word (a noncharacter).
_JOIN_MARK = "chr(64976)"
# Code points of the word-boundary classes, stated apart from the operator.
_MID_LETTER = (0x3A, 0xB7, 0x387, 0x5F4, 0x2027, 0xFE13, 0xFE55, 0xFF1A)
_MID_NUM_LET = (0x2E, 0x2018, 0x2019, 0x2024, 0xFE52, 0xFF07, 0xFF0E)
_MID_NUM = (0x2C, 0x3B, 0x37E, 0x589, 0x60C, 0x60D, 0x66C, 0x7F8, 0x2044, 0xFE10, 0xFE14, 0xFE50, 0xFE54, 0xFF0C, 0xFF1B)
_UNDERSCORES = (0x5F, 0x203F, 0x2040, 0x2054, 0xFE33, 0xFE34, 0xFE4D, 0xFE4E, 0xFE4F, 0xFF3F)
_KATAKANA_MARKS = (0x3031, 0x3032, 0x3033, 0x3034, 0x3035, 0x309B, 0x309C, 0x30A0, 0x30FC, 0xFF70, 0xFF9E, 0xFF9F)
_APOSTROPHE, _QUOTE, _ZERO_WIDTH_SPACE = 0x27, 0x22, 0x200B


def _chars(*points: int) -> str:
    return "".join(f"\\x{{{p:X}}}" for p in points)


_KX = _chars(*_KATAKANA_MARKS)
_OWN = r"\p{Han}\p{Hiragana}\p{Katakana}" + _KX
_KATA = r"[\p{Katakana}" + _KX + "]"
_LW = rf"[^\P{{L}}{_OWN}]"
_W = rf"(?:[^\P{{L}}{_OWN}]|[^\P{{N}}{_OWN}])"
_HEB = r"[\x{5D0}-\x{5EA}\x{5EF}-\x{5F2}\x{FB1D}\x{FB1F}-\x{FB28}\x{FB2A}-\x{FB36}\x{FB38}-\x{FB3C}\x{FB3E}\x{FB40}\x{FB41}\x{FB43}\x{FB44}\x{FB46}-\x{FB4F}]"
_X = r"[\p{M}\p{Cf}]*"          # the zero width space is gone before this is used
_EXT = f"[{_chars(*_UNDERSCORES)}]"


def tokens_sql(text: str) -> str:
    """The analysed tokens of ``lower(text)``, restated for RE2 (no look-around):
    a space is put wherever Katakana meets a letter or digit and for every zero
    width space; joiners between two letters, two digits or two Hebrew letters
    are marked, in two passes each (a pass cannot reuse the letter it consumed),
    as is a quote that ends a Hebrew word; words are extracted with a marked
    character allowed inside, and the marks removed."""
    x = f"replace(lower({text}), chr({_ZERO_WIDTH_SPACE}), ' ')"
    x = f"regexp_replace({x}, '({_KATA}{_X})({_W})', '\\1 \\2', 'g')"
    x = f"regexp_replace({x}, '({_W}{_X})({_KATA})', '\\1 \\2', 'g')"
    for side, joiners in ((_LW, (*_MID_LETTER, *_MID_NUM_LET, _APOSTROPHE)), (r"\p{Nd}", (*_MID_NUM, *_MID_NUM_LET, _APOSTROPHE)), (_HEB, (_QUOTE,))):
        for _ in range(2):
            x = f"regexp_replace({x}, '({side}{_X})([{_chars(*joiners)}])({_X}{side})', '\\1' || {_JOIN_MARK} || '\\2\\3', 'g')"
    x = f"regexp_replace({x}, '({_HEB}{_X})({_chars(_APOSTROPHE)}{_X})', '\\1' || {_JOIN_MARK} || '\\2 ', 'g')"
    word = (f"'[\\p{{Han}}\\p{{Hiragana}}]{_X}|(?:{_EXT}{_X})*(?:{_W}|{_KATA})(?:{_W}|{_KATA}|{_EXT}|[\\p{{M}}\\p{{Cf}}]|' "
            f"|| {_JOIN_MARK} || '.)*'")
    return f"list_transform(regexp_extract_all({x}, {word}), lambda t: replace(t, {_JOIN_MARK}, ''))"


# --- feeds (same text as sources.fixtures) ---------------------------------

EVENTS_LINES = r"""SELECT event_id AS src_key,
  concat_ws(',', CAST(year(ts) AS VARCHAR), lpad(CAST(month(ts) AS VARCHAR), 2, '0'),
    lpad(CAST(day(ts) AS VARCHAR), 2, '0'),
    CASE WHEN event_id % 17 = 0 THEN '\N' WHEN event_id % 19 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END,
    CASE WHEN event_id % 23 = 0 THEN event_type || '\,x' ELSE event_type END,
    CAST(event_id AS VARCHAR))
  || CASE WHEN event_id % 29 = 0 THEN ',extra' ELSE '' END AS value
FROM events"""

ORDERS_LINES = r"""SELECT o_orderkey AS src_key,
  concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus,
    CASE WHEN o_orderkey % 13 = 0 THEN '\N' ELSE o_orderpriority END,
    CAST(year(o_orderdate) AS VARCHAR)) AS value
FROM orders"""

PART_LINES = r"""SELECT p_partkey AS src_key,
  concat_ws(chr(1), CAST(p_partkey AS VARCHAR), p_name, p_brand, p_type,
    CASE WHEN p_partkey % 31 = 0 THEN 'bad' ELSE CAST(p_size AS VARCHAR) END) AS value
FROM part"""

DOCS_LINES = r"""SELECT doc_id AS src_key,
  concat_ws(',', CAST(doc_id AS VARCHAR), lang, source,
    replace(replace(text, chr(10), ' '), ',', '\,')) AS value
FROM documents"""

FEED_SQL = {"event": EVENTS_LINES, "order": ORDERS_LINES, "part": PART_LINES, "doc": DOCS_LINES}


def parsed_sql(tspec: TypeSpec, ispec: IndexSpec, lines: str) -> str:
    """One row per line, as ``parse_lines`` with key ids: ``_type, _line,
    _status, _reason, <fields>, <_p_ partition values>, _index, _shard, _id``.
    ``lines`` is a relation with a ``value`` column."""
    names = tspec.field_names
    n = len(names)
    ri = tspec.routing_index
    st = ["WHEN value = '' THEN 'rejected'"]
    rs = ["WHEN value = '' THEN 'empty_line'"]
    if ri is not None:
        st.append(f"WHEN len(_f) > {ri} AND _f[{ri + 1}] IN ('', '\\N') THEN 'dropped'")
        rs.append(f"WHEN len(_f) > {ri} AND _f[{ri + 1}] IN ('', '\\N') THEN NULL")
    st.append(f"WHEN len(_f) <> {n} THEN 'rejected'")
    rs.append(f"WHEN len(_f) <> {n} THEN 'arity'")
    for m in tspec.mapping or ():
        if m.data_type == "string":
            continue
        v = field_value_sql(f"_f[{tspec.index_of(m.field) + 1}]")
        bad = f"{v} IS NOT NULL AND TRY_CAST({v} AS {_DUCK_TYPES[m.data_type]}) IS NULL"
        if m.data_type in _DUCK_FORMS:
            bad = f"({bad} OR NOT regexp_full_match({v}, '{_DUCK_FORMS[m.data_type]}'))"
        st.append(f"WHEN {bad} THEN 'rejected'")
        rs.append(f"WHEN {bad} THEN 'coercion:{m.field}'")
    status = "CASE " + " ".join(st) + " ELSE 'ok' END"
    reason = "CASE " + " ".join(rs) + " ELSE NULL END"
    fields = [f"{field_value_sql(f'_f[{i + 1}]')} AS {name}" for i, name in enumerate(names)]
    pf = list(ispec.partition_fields or ())
    pcols = [f"_f[{tspec.index_of(p) + 1}] AS _p_{p}" for p in pf]
    if pf:
        index = f"'{ispec.name}@' || concat_ws('-', {', '.join('_f[%d]' % (tspec.index_of(p) + 1) for p in pf)})"
    else:
        index = f"'{ispec.name}'"
    keys = [f"_f[{tspec.index_of(k) + 1}]" for k in (tspec.key_fields or ())]
    doc_id = hash_id_sql(f"'{tspec.name}'", *keys) if keys else "NULL"
    if ri is not None:
        shard = routed_shard_sql(f"_f[{ri + 1}]", ispec.num_shards)
    elif keys:
        shard = routed_shard_sql(doc_id, ispec.num_shards)
    else:
        shard = "NULL::INTEGER"
    ok = f"({status}) = 'ok'"
    return f"""SELECT '{tspec.name}' AS _type, value AS _line, {status} AS _status, {reason} AS _reason,
  {', '.join(fields + pcols)},
  CASE WHEN {ok} THEN {index} END AS _index,
  CASE WHEN {ok} THEN {shard} END AS _shard,
  CASE WHEN {ok} THEN {doc_id} END AS _id
FROM (SELECT value, {split_sql('value', tspec.field_sep)} AS _f FROM ({lines}))"""


def docs_sql(tspec: TypeSpec, ispec: IndexSpec, lines: str | None = None) -> str:
    """Documents (``ok`` rows) with fields, index, shard, _id."""
    lines = lines or FEED_SQL[tspec.name]
    return f"SELECT * FROM ({parsed_sql(tspec, ispec, lines)}) WHERE _status = 'ok'"


def union_docs_sql(ispec: IndexSpec) -> str:
    """``index, shard, type, _id`` of every type of the index."""
    return " UNION ALL ".join(f"SELECT _index AS index, _shard AS shard, _type AS type, _id FROM ({docs_sql(t, ispec)})"
                              for t in ispec.types)


def grid_sql(per_shard: str, n: int) -> str:
    """Dense grid from a relation ``(index, shard, doc_count)``."""
    return f"""WITH ps AS ({per_shard}),
g AS (SELECT DISTINCT index, CAST(s.shard AS INTEGER) AS shard FROM ps,
      (SELECT unnest(range(0, {n})) AS shard) s)
SELECT g.index, g.shard, CAST(coalesce(ps.doc_count, 0) AS BIGINT) AS doc_count,
  ps.doc_count IS NULL AS is_empty
FROM g LEFT JOIN ps ON g.index = ps.index AND g.shard = ps.shard"""


def inferred_mapping_sql(ispec: IndexSpec) -> str:
    """``(index, type, field)`` with at least one non-null value."""
    parts = []
    for t in ispec.types:
        parts.append(
            f"SELECT DISTINCT _index AS index, _type AS type, fld AS field FROM (SELECT _index, _type, "
            f"unnest([{', '.join(f'CASE WHEN {f} IS NOT NULL THEN {lit(f)} END' for f in t.field_names)}]) AS fld "
            f"FROM ({docs_sql(t, ispec)})) WHERE fld IS NOT NULL")
    return " UNION ALL ".join(parts)


def merged_mapping_sql(ispec: IndexSpec, explicit_rows: list[tuple[str, str, str, str]] | None = None) -> str:
    if explicit_rows is None:
        explicit_rows = [(t.name, m.field, m.data_type, m.index_mode) for t in ispec.types for m in t.mapping or ()]
    if explicit_rows:
        vals = ", ".join(f"({lit(a)}, {lit(b)}, {lit(c)}, {lit(d)})" for a, b, c, d in explicit_rows)
        explicit = f"SELECT * FROM (VALUES {vals}) v(type, field, data_type, index_mode)"
    else:
        explicit = ("SELECT NULL::VARCHAR AS type, NULL::VARCHAR AS field, NULL::VARCHAR AS data_type, "
                    "NULL::VARCHAR AS index_mode WHERE false")
    return f"""WITH inf AS ({inferred_mapping_sql(ispec)}),
tin AS (SELECT DISTINCT index, type FROM ({union_docs_sql(ispec)})),
ex AS (SELECT tin.index, ex0.* FROM tin JOIN ({explicit}) ex0 ON tin.type = ex0.type)
SELECT coalesce(inf.index, ex.index) AS index, coalesce(inf.type, ex.type) AS type,
  coalesce(inf.field, ex.field) AS field,
  coalesce(ex.data_type, 'string') AS data_type, coalesce(ex.index_mode, 'not_analyzed') AS index_mode,
  CASE WHEN ex.data_type IS NOT NULL THEN 'explicit' ELSE 'inferred' END AS origin
FROM inf FULL OUTER JOIN ex ON inf.index = ex.index AND inf.type = ex.type AND inf.field = ex.field"""

