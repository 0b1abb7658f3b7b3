"""Job specification: an index built from one or more typed, delimited feeds.

The spec is configuration only; it never holds data.  Everything it implies
(field positions, separators, the routing column, the partition columns) is
turned into literals in the Spark plan by the operators.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from typing import Any

# The separator token that stands for the control character
# \x01 (the default separator of Hive text tables), and the two raw tokens
# that mean "no value".
HIVE_SEPARATOR_TOKEN = "u0001"
DEFAULT_SEPARATOR = "\x01"
NULL_TOKENS = ("", "\\N")

# The keys of a job specification in JSON, for an index and for a type.
KEY_INDEX, KEY_SHARDS, KEY_PARTITIONS, KEY_TYPES = "indexName", "numOfShards", "partitionFields", "types"
KEY_TYPE, KEY_PATH, KEY_FIELDS, KEY_SEPARATOR, KEY_MAPPING, KEY_ROUTING = "name", "inputPath", "fieldNames", "fieldSplitter", "mapping", "routingField"

# Field types accepted in an explicit mapping, and the Spark type each one is
# coerced to.  "string" is kept as text.
DATA_TYPES = {
    "string": "string",
    "byte": "tinyint",
    "short": "smallint",
    "integer": "int",
    "long": "bigint",
    "float": "float",
    "double": "double",
    "boolean": "boolean",
    "date": "date",
    "timestamp": "timestamp",
}
# A text is a date or time only if it has the whole form; a cast alone would
# take "2024" or drop what follows a date.
STRICT_FORMS = {
    "date": r"^\d{4}-\d{2}-\d{2}$",
    "timestamp": r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-]\d{2}:\d{2})?$",
}
NUMBER_TYPES = ("byte", "short", "integer", "long", "float", "double")
# Index modes: exact-value terms, analysed text terms, or not indexed.
INDEX_MODES = ("not_analyzed", "analyzed", "no")
DEFAULT_DATA_TYPE = "string"
# Columns of the document table; a partition field (also kept as a column)
# may not take one of these names.
RESERVED_COLUMNS = ("index", "shard", "type", "doc", "value", "reason")
DEFAULT_INDEX_MODE = "not_analyzed"


class SpecError(ValueError):
    """An index or type specification that cannot be built."""


def separator_from_token(token: str) -> str:
    """``u0001`` means the control character \\x01; otherwise the first character."""
    if token is None or token == "":
        raise SpecError("empty field separator")
    if token == HIVE_SEPARATOR_TOKEN:
        return DEFAULT_SEPARATOR
    return token[0]


def separator_to_token(sep: str) -> str:
    return HIVE_SEPARATOR_TOKEN if sep == DEFAULT_SEPARATOR else sep


@dataclass(frozen=True)
class FieldMapping:
    field: str
    data_type: str = DEFAULT_DATA_TYPE
    index_mode: str = DEFAULT_INDEX_MODE

    def __post_init__(self):
        if self.data_type not in DATA_TYPES:
            raise SpecError(f"unknown data type {self.data_type!r} for field {self.field!r}")
        if self.index_mode not in INDEX_MODES:
            raise SpecError(f"unknown index mode {self.index_mode!r} for field {self.field!r}")
        if self.index_mode == "analyzed" and self.data_type != "string":
            raise SpecError(f"only string fields can be analyzed: {self.field!r}")


@dataclass(frozen=True)
class FieldTemplate:
    """What an undeclared field is mapped to if its name fits: the first template that fits decides.

    ``match`` and ``unmatch`` are patterns of the whole name with ``*`` for any text, or
    regular expressions with ``regex=True``; ``value_type`` is the type that values must be
    seen as, and every value of a delimited feed is text (``string``).
    """

    name: str
    match: str = "*"
    unmatch: str | None = None
    value_type: str = "*"
    regex: bool = False
    data_type: str = DEFAULT_DATA_TYPE
    index_mode: str = DEFAULT_INDEX_MODE

    def __post_init__(self):
        FieldMapping(self.name, self.data_type, self.index_mode)
        for pattern in (self.match, self.unmatch or ""):
            try:
                re.compile(self._pattern(pattern))
            except re.error as bad:
                raise SpecError(f"template {self.name!r}: {pattern!r} is no pattern ({bad})") from bad

    def _pattern(self, pattern: str) -> str:
        return pattern if self.regex else ".*".join(map(re.escape, pattern.split("*")))

    def fits(self, field_name: str) -> bool:
        whole = lambda pattern: re.fullmatch(self._pattern(pattern), field_name, re.DOTALL) is not None
        return (self.value_type in ("*", DEFAULT_DATA_TYPE) and whole(self.match)
                and not (self.unmatch is not None and whole(self.unmatch)))

    def to_dict(self) -> dict[str, Any]:
        d: dict[str, Any] = {"match": self.match}
        if self.unmatch is not None:
            d["unmatch"] = self.unmatch
        if self.value_type != "*":
            d["match_mapping_type"] = self.value_type
        if self.regex:
            d["match_pattern"] = "regex"
        return {self.name: {**d, "mapping": {"type": self.data_type, "index": self.index_mode}}}

    @classmethod
    def from_dict(cls, name: str, rule: dict[str, Any]) -> "FieldTemplate":
        """A template as a search index states it; documents are flat, so a path is a name."""
        rule = dict(rule)
        how = rule.pop("mapping", {})
        other = set(how) - {"type", "index"}
        names = {"match": rule.pop("path_match", rule.pop("match", "*")), "unmatch": rule.pop("path_unmatch", rule.pop("unmatch", None)),
                 "value_type": rule.pop("match_mapping_type", "*"), "regex": rule.pop("match_pattern", "simple") == "regex"}
        if rule or other:
            raise SpecError(f"template {name!r}: settings {sorted({*rule, *other})} are not supported")
        seen_as = how.get("type", DEFAULT_DATA_TYPE)
        return cls(name, **names, data_type=DEFAULT_DATA_TYPE if seen_as == "{dynamic_type}" else seen_as,
                   index_mode=how.get("index", DEFAULT_INDEX_MODE))


def _mapping_parts(mapping, type_name: str):
    """The field properties and templates of a mapping given as JSON text, as a search
    index's document ``{type: {"properties": ..., "dynamic_templates": ...}}``, or already
    as properties.  Other settings are an error rather than silently ignored."""
    if isinstance(mapping, str):
        mapping = json.loads(mapping)
    if not isinstance(mapping, dict):
        return mapping, ()
    body = mapping
    if set(mapping) == {type_name} and isinstance(mapping[type_name], dict) and set(mapping[type_name]) & {"properties", "dynamic_templates"}:
        body = mapping[type_name]
    if not isinstance(body.get("properties"), dict) and "dynamic_templates" not in body:
        return mapping, ()
    other = set(body) - {"properties", "dynamic_templates"}
    if other:
        raise SpecError(f"mapping of type {type_name!r}: settings {sorted(other)} are not supported")
    templates = tuple(FieldTemplate.from_dict(name, rule) for t in body.get("dynamic_templates", ()) for name, rule in t.items())
    return body.get("properties", {}), templates


def _mapping_tuple(mapping) -> tuple[FieldMapping, ...] | None:
    if mapping is None:
        return None
    if isinstance(mapping, dict):
        out = []
        for name, v in mapping.items():
            if isinstance(v, str):
                out.append(FieldMapping(name, v))
            elif isinstance(v, dict):
                other = set(v) - {"type", "index"}
                if other:
                    raise SpecError(f"mapping of field {name!r}: settings {sorted(other)} are not supported")
                out.append(FieldMapping(name, v.get("type", DEFAULT_DATA_TYPE), v.get("index", DEFAULT_INDEX_MODE)))
            else:
                out.append(FieldMapping(name, *v))
        return tuple(out)
    return tuple(m if isinstance(m, FieldMapping) else FieldMapping(*m) for m in mapping)


@dataclass(frozen=True)
class TypeSpec:
    """One document type: where its lines are and how to read them.

    ``mapping`` states fields, and ``templates`` what the others are mapped to by
    their names (both in one, if ``mapping`` is given as a search index states it).
    ``key_fields`` optionally names fields that are unique per line; document
    ids are then a hash of them (see ``functions.ids``).  ``record_sep`` ends a
    line of the feed (default: line ends); with ``max_line_bytes``, lines that
    long or longer (their end included) are left out.
    """

    name: str
    field_names: tuple[str, ...]
    input_path: str | None = None
    field_sep: str = DEFAULT_SEPARATOR
    mapping: tuple[FieldMapping, ...] | None = None
    routing_field: str | None = None
    key_fields: tuple[str, ...] | None = None
    record_sep: str | None = None
    max_line_bytes: int | None = None
    templates: tuple[FieldTemplate, ...] = ()

    def __post_init__(self):
        object.__setattr__(self, "field_names", tuple(self.field_names))
        properties, templates = _mapping_parts(self.mapping, self.name)
        object.__setattr__(self, "mapping", _mapping_tuple(properties))
        object.__setattr__(self, "templates", tuple(self.templates) or templates)
        if self.key_fields is not None:
            object.__setattr__(self, "key_fields", tuple(self.key_fields))
        if not self.name:
            raise SpecError("type name is required")
        if "{" in self.name:
            raise SpecError(f"type name may not contain '{{': {self.name!r}")
        if not self.field_names:
            raise SpecError(f"type {self.name!r} declares no fields")
        for f in self.field_names:
            if not f or f.startswith("_"):
                raise SpecError(f"type {self.name!r}: field names may not be empty or start with '_': {f!r}")
        if len(set(self.field_names)) != len(self.field_names):
            raise SpecError(f"type {self.name!r} repeats a field name")
        if len(self.field_sep) != 1:
            raise SpecError(f"type {self.name!r}: the separator must be one character")
        if self.field_sep == "\\":
            raise SpecError("the backslash is the escape character and cannot separate fields")
        if self.record_sep == "":
            raise SpecError(f"type {self.name!r}: the record separator may not be empty")
        if self.max_line_bytes is not None and self.max_line_bytes < 1:
            raise SpecError(f"type {self.name!r}: max_line_bytes must be positive")
        if self.routing_field is not None and self.routing_field not in self.field_names:
            raise SpecError(f"type {self.name!r} routes by {self.routing_field!r}, which is none of its fields")
        for k in self.key_fields or ():
            if k not in self.field_names:
                raise SpecError(f"key field {k!r} is not a field of type {self.name!r}")
        for m in self.mapping or ():
            if m.field not in self.field_names:
                raise SpecError(f"mapping names {m.field!r}, not a field of type {self.name!r}")

    def index_of(self, field_name: str) -> int:
        return self.field_names.index(field_name)

    @property
    def routing_index(self) -> int | None:
        return None if self.routing_field is None else self.index_of(self.routing_field)

    def explicit_mapping(self) -> dict[str, FieldMapping]:
        return {m.field: m for m in self.mapping or ()}

    def field_mapping(self) -> dict[str, FieldMapping]:
        """The mapping of each field that has one: its own, else that of the first template that fits."""
        out = self.explicit_mapping()
        for name in self.field_names:
            if name not in out:
                fit = next((t for t in self.templates if t.fits(name)), None)
                if fit is not None:
                    out[name] = FieldMapping(name, fit.data_type, fit.index_mode)
        return out

    def to_dict(self) -> dict[str, Any]:
        d = {KEY_TYPE: self.name, KEY_FIELDS: ",".join(self.field_names),
             KEY_SEPARATOR: separator_to_token(self.field_sep)}
        if self.input_path is not None:
            d[KEY_PATH] = self.input_path
        if self.routing_field is not None:
            d[KEY_ROUTING] = self.routing_field
        if self.key_fields:
            d["keyFields"] = ",".join(self.key_fields)
        if self.record_sep is not None:
            d["recordSplitter"] = self.record_sep
        if self.max_line_bytes is not None:
            d["maxLineBytes"] = self.max_line_bytes
        if self.mapping:
            d[KEY_MAPPING] = {m.field: {"type": m.data_type, "index": m.index_mode}
                            for m in self.mapping}
        if self.templates:
            d[KEY_MAPPING] = {"properties": d.get(KEY_MAPPING, {}), "dynamic_templates": [t.to_dict() for t in self.templates]}
        return d

    @classmethod
    def from_dict(cls, d: dict[str, Any]) -> "TypeSpec":
        fields = d[KEY_FIELDS]
        if isinstance(fields, str):
            fields = [f for f in fields.split(",")]
        keys = d.get("keyFields")
        if isinstance(keys, str):
            keys = keys.split(",")
        return cls(name=d[KEY_TYPE], field_names=tuple(fields), input_path=d.get(KEY_PATH),
                   field_sep=separator_from_token(d.get(KEY_SEPARATOR, HIVE_SEPARATOR_TOKEN)),
                   mapping=d.get(KEY_MAPPING), routing_field=d.get(KEY_ROUTING),
                   key_fields=keys, record_sep=d.get("recordSplitter"),
                   max_line_bytes=None if d.get("maxLineBytes") is None else int(d["maxLineBytes"]))


@dataclass(frozen=True)
class IndexSpec:
    """An index: a name, a shard count, its types and optional partition fields.

    With partition fields every line goes to the physical index
    ``name@v1-v2-...`` built from the raw values of those fields.  A line of a
    type without a routing field goes to the shard of its id, or with
    ``unrouted="random"`` to any shard (another one when a task is retried).
    """

    name: str
    num_shards: int = 5
    types: tuple[TypeSpec, ...] = field(default_factory=tuple)
    partition_fields: tuple[str, ...] | None = None
    replicas: int = 1
    version: int = 2
    unrouted: str = "id"

    def __post_init__(self):
        if self.unrouted not in ("id", "random"):
            raise SpecError(f"unrouted must be 'id' or 'random': {self.unrouted!r}")
        object.__setattr__(self, "types", tuple(self.types))
        if self.partition_fields is not None:
            object.__setattr__(self, "partition_fields", tuple(self.partition_fields))
        if not self.name:
            raise SpecError("index name is required")
        if not isinstance(self.num_shards, int) or self.num_shards < 1:
            raise SpecError("num_shards must be a positive integer")
        names = [t.name for t in self.types]
        if len(set(names)) != len(names):
            raise SpecError("type names must be unique")
        for p in self.partition_fields or ():
            if p in RESERVED_COLUMNS:
                raise SpecError(f"partition field {p!r} collides with a document table column")
            for t in self.types:
                if p not in t.field_names:
                    raise SpecError(f"indices are named by {p!r}, which is no field of type {t.name!r}")

    @property
    def partitioned(self) -> bool:
        return bool(self.partition_fields)

    def type(self, name: str) -> TypeSpec:
        for t in self.types:
            if t.name == name:
                return t
        raise SpecError(f"unknown type {name!r}")

    def to_dict(self) -> dict[str, Any]:
        d = {KEY_INDEX: self.name, KEY_SHARDS: self.num_shards,
             KEY_TYPES: [t.to_dict() for t in self.types],
             "replicas": self.replicas, "version": self.version}
        if self.unrouted != "id":
            d["unrouted"] = self.unrouted
        if self.partition_fields:
            d[KEY_PARTITIONS] = ",".join(self.partition_fields)
        return d

    @classmethod
    def from_dict(cls, d: dict[str, Any]) -> "IndexSpec":
        pf = d.get(KEY_PARTITIONS)
        if isinstance(pf, str):
            pf = pf.split(",")
        if KEY_SHARDS not in d or KEY_INDEX not in d:
            raise SpecError("indexName and numOfShards are required")
        return cls(name=d[KEY_INDEX], num_shards=int(d[KEY_SHARDS]),
                   types=tuple(TypeSpec.from_dict(t) for t in d.get(KEY_TYPES, ())),
                   partition_fields=pf, replicas=int(d.get("replicas", 1)),
                   version=int(d.get("version", 2)), unrouted=d.get("unrouted", "id"))
