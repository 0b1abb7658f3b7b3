"""Chat formatting with rotating perspective.

For every participant of a conversation (each speaker but ``system``) the
dialogue is rendered once with that speaker as ``assistant``, the others as
named users, and a loss mask: the spans (code points, end exclusive) of the
participant's own texts with their end mark.

A long conversation is rendered in parts of ``turns`` turn numbers, and a part
with many rows in pieces of ``rows`` rows, so no output row, and no group
collected for one, grows without bound.  Participants come from the whole
conversation: a part in which the participant does not speak has an empty mask.
With ``turns=None`` and ``rows=None`` a conversation is rendered whole, however
long, by one task; that is for conversations of known size.

Speakers are told apart by their role as it stands.  A shown name has ``_`` for
white space and ``##`` for ``#``; of speakers of one conversation whose names would
look the same, the second in code-point order gets ``#2``, the third ``#3``, and so on.

Defined results: turns are ordered by number, role, text, so ties and
repeated rows have a fixed order and all stay; a null role is the speaker
``unknown``, a null text is empty; turns without number form a part of their
own (null); a row without ``conv_id`` is a conversation of its own; a
conversation of system turns only has no participant and gives no row; marks
inside texts and names are broken up, so a text cannot end its turn; a text of any
length is kept whole; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TURNS = 64
ROWS = 256
START, END = "<|im_start|>", "<|im_end|>"


def _names(t: DataFrame) -> DataFrame:
    """``c, a, names`` of every conversation: its speakers' shown names by role."""
    shown = F.regexp_replace(F.replace(F.replace("role", F.lit("<|"), F.lit("< |")), F.lit("#"), F.lit("##")), r"\s", "_")
    each = t.select("conv_id", "alone", "role").distinct().withColumn("shown", shown)
    alike = F.row_number().over(Window.partitionBy("conv_id", "alone", "shown").orderBy("role"))
    name = F.concat("shown", F.when(F.col("k") > 1, F.concat(F.lit("#"), F.col("k"))).otherwise(""))
    return (each.withColumn("k", alike).groupBy(F.col("conv_id").alias("c"), F.col("alone").alias("a"))
            .agg(F.map_from_entries(F.collect_list(F.struct("role", name.alias("name")))).alias("names")))


def rotations(turns_df: DataFrame, turns: int | None = TURNS, rows: int | None = ROWS) -> DataFrame:
    """``conv_id, part, piece, perspective, n_turns, text, mask`` (array of
    ``start, end``) for ``turns_df(conv_id, turn, role, text)``."""
    t = turns_df.select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"),
                        F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"))
    t = (t.withColumn("part", F.floor(F.col("turn") / turns) if turns else F.lit(0).cast("bigint"))
         .withColumn("alone", F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text"))))
    speakers = F.filter(F.map_keys("names"), lambda r: r != "system")
    cast = _names(t).select("c", "a", "names", F.explode(speakers).alias("me"))
    order = Window.partitionBy("conv_id", "alone", "part").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    piece = F.floor(F.col("rn") / rows) if rows else F.lit(0).cast("bigint")
    groups = (t.withColumn("rn", F.row_number().over(order) - 1).withColumn("piece", piece)
              .groupBy("conv_id", "alone", "part", "piece")
              .agg(F.array_sort(F.collect_list(F.struct("rn", "role", "text"))).alias("said")))
    both = groups.join(cast, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("alone").eqNullSafe(F.col("a")))
    mine = lambda s: s.role == F.col("me")
    head = lambda s: F.concat(F.lit(START), F.when(mine(s), "assistant").when(s.role == "system", "system")
                              .otherwise(F.concat(F.lit("user name="), F.element_at("names", s.role))), F.lit("\n"))
    made = both.withColumn("segs", F.transform("said", lambda s: F.struct(
        mine(s).alias("own"), F.length(head(s)).alias("pre"), F.concat(head(s), s.text, F.lit(END + "\n")).alias("seg"))))
    before = lambda i: F.aggregate(F.slice("segs", F.lit(1), i), F.lit(0), lambda n, s: n + F.length(s.seg))
    spans = F.transform("segs", lambda s, i: F.struct(s.own.alias("own"), (before(i) + s.pre).alias("start"), (before(i) + F.length(s.seg) - 1).alias("end")))
    return made.select("conv_id", "part", "piece", F.element_at("names", F.col("me")).alias("perspective"), F.size("segs").alias("n_turns"),
                       F.array_join(F.transform("segs", lambda s: s.seg), "").alias("text"),
                       F.transform(F.filter(spans, lambda s: s.own), lambda s: F.struct(s.start.alias("start"), s.end.alias("end"))).alias("mask"))


__all__ = ["TURNS", "ROWS", "rotations"]
