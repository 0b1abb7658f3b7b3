"""``k:v,k:v`` strings to and from maps.

``map_to_str`` writes the entries sorted by key so the text is deterministic.
``str_to_map`` gives null unless the text has a ``:`` with at least one
character on each side and no line terminator (the whole-string test
``(.+:.+,?)+``, written without its backtracking); entries are split on
unescaped ``,`` and each entry on unescaped ``:`` (first two parts), the last
duplicate key wins, and an entry without a ``:`` (or an empty entry) is an
error, as it is for the source format.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import separator_regex, split_escaped

# Fixed value: Java's line terminators, which '.' does not match.
LINE_TERMINATORS = "\\n\\r\\u0085\\u2028\\u2029"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_to_str(m) -> Column:
    entries = F.array_sort(F.map_entries(_col(m)))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit(":"),
                                                F.coalesce(e["value"], F.lit("null")))),
        ",")


def str_to_map_valid(s) -> Column:
    s = _col(s)
    no_terminator = ~s.rlike("[" + LINE_TERMINATORS + "]")
    first_inner_colon = F.locate(":", s, 2)
    return no_terminator & (first_inner_colon >= 2) & (first_inner_colon <= F.length(s) - 1)


def str_to_map(s) -> Column:
    """Entries sorted by key, the last of each key kept (n log n in the number
    of entries); an entry without a ``:`` raises."""
    s = _col(s)
    colon = separator_regex(":")
    pairs = F.transform(split_escaped(s, ","), lambda c: F.split(c, colon, -1))

    checked = F.transform(pairs, lambda p: F.when(F.size(p) < 2, F.raise_error(F.concat(F.lit("malformed map entry in: "), s))
                                                  .cast("struct<key:string,value:string>"))
                          .otherwise(F.struct(F.get(p, 0).alias("key"), F.get(p, 1).alias("value"))))
    # the last entry of a key wins: numbered entries sorted by key, those before another of their key left out
    sorted_ = F.array_sort(F.transform(checked, lambda e, i: F.struct(e["key"].alias("key"), i.alias("at"), e["value"].alias("value"))))

    def last(es):
        return F.filter(F.zip_with(es, F.slice(es, F.lit(2), F.size(es)), lambda e, n: F.struct(
            e["key"].alias("key"), e["value"].alias("value"), (n["key"].isNull() | (n["key"] != e["key"])).alias("keep"))), lambda x: x["keep"])

    # bound to lambda variables, so each array is made once
    folded = F.element_at(F.transform(F.array(sorted_), lambda es: F.map_from_entries(
        F.transform(last(es), lambda x: F.struct(x["key"], x["value"])))), 1)
    return F.when(~str_to_map_valid(s), F.lit(None).cast("map<string,string>")).otherwise(folded)
