"""Line and field text rules, as JVM-side column expressions.

Rules kept from the source format:

* a separator preceded by a backslash does not split; leading, repeated and
  trailing separators give empty fields;
* an empty field or the two characters ``\\N`` mean null;
* a value whose first backslash is *after* its first character loses every
  backslash; a value that starts with a backslash keeps them all.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..spec import NULL_TOKENS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _separator_literal(sep: str) -> str:
    if len(sep) != 1:
        raise ValueError("separator must be one character")
    return sep if (sep.isalnum() or ord(sep) < 32 or ord(sep) > 126) else "\\" + sep


def separator_regex(sep: str) -> str:
    """Java regex that matches an unescaped ``sep``."""
    return r"(?<!\\)" + _separator_literal(sep)


def split_escaped(value, sep: str) -> Column:
    """Escape-aware split; ``limit=-1`` keeps trailing empty fields.

    A line without a backslash has no escaped separator, so it takes the
    plain split on the one character (no regex is run); only lines with a
    backslash take the look-behind pattern.  Both give the same fields.
    """
    v = _col(value)
    return F.when(F.instr(v, "\\") > 0, F.split(v, separator_regex(sep), -1)) \
        .otherwise(F.split(v, _separator_literal(sep), -1))


def split_escaped_by(value, sep_col) -> Column:
    """Same as :func:`split_escaped`, with the separator taken from a column
    (one character per row, e.g. from a joined type table)."""
    v, sep = _col(value), _col(sep_col)
    quoted = F.concat(F.lit(r"\Q"), sep, F.lit(r"\E"))
    # as in split_escaped: only a line with a backslash needs the look-behind
    return F.when(F.instr(v, "\\") > 0, F.split(v, F.concat(F.lit(r"(?<!\\)"), quoted), F.lit(-1))) \
        .otherwise(F.split(v, quoted, F.lit(-1)))


def null_token(raw) -> Column:
    """Raw token -> null when it is empty or ``\\N``."""
    raw = _col(raw)
    return F.when(raw.isin(*NULL_TOKENS), F.lit(None).cast("string")).otherwise(raw)


def unescape(v) -> Column:
    """Drop every backslash, but only when the first one is not the first character."""
    v = _col(v)
    return F.when(F.instr(v, "\\") > 1, F.translate(v, "\\", "")).otherwise(v)


def field_value(raw) -> Column:
    """Null test on the raw token first, unescape after."""
    return unescape(null_token(raw))


# Fixed value: the characters String.trim() removes, U+0000 .. U+0020.
TRIM_CHARS = "".join(chr(i) for i in range(0, 33))


def is_blank(value) -> Column:
    """True when nothing but control characters and spaces remain after trim."""
    return F.trim(_col(value), F.lit(TRIM_CHARS)) == ""


def octet_length(value) -> Column:
    return F.octet_length(_col(value))
