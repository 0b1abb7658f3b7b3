"""Streaming variant of the document stage (file source -> file sink)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.parse import build_rows, parse_lines
from ..sinks.layout import DOCUMENTS, table_path
from ..sources.lines import filter_long_lines
from ..spec import IndexSpec


def stream_rows(spark: SparkSession, ispec: IndexSpec, type_name: str, path: str, *,
                mode: str = "quarantine", id_mode: str = "key", line_sep: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Documents (and quarantined rejects) of new files under ``path``.

    Ids must be ``key`` (from the type's unique key fields) or ``random``:
    a position in a scan split is not stable across micro-batches.
    """
    if id_mode in ("position", "content"):
        raise ValueError(f"{id_mode} ids need a bounded scan; use id_mode='key' or 'random' on a stream")
    t = ispec.type(type_name)
    sep = t.record_sep if t.record_sep is not None else line_sep
    reader = spark.readStream.format("text")
    if sep is not None:
        reader = reader.option("lineSep", sep)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = filter_long_lines(reader.load(path), t.max_line_bytes, sep or "\n")
    return build_rows(parse_lines(lines, t, ispec, id_mode=id_mode), t, ispec, mode=mode)


def write_stream(rows: DataFrame, out: str, checkpoint_location: str, *,
                 available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Append to ``{out}/documents`` through the file sink (exactly once: the
    sink's log lists committed files; readers of the folder honour it).  Use
    a folder of its own, not one that batch builds overwrite."""
    w = (rows.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint_location)
         .option("path", table_path(out, DOCUMENTS))
         .partitionBy("index"))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time is not None:
        w = w.trigger(processingTime=processing_time)
    return w.start()
