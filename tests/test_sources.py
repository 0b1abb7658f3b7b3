"""Line scans: record delimiters, codecs chosen by extension, the long-line filter."""

import pytest

from shardloom.sources import fixtures as fx
from shardloom.sources import lines as ln
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("codec,sep", [("bzip2", None), ("gzip", ";"), (None, "\x02")])
def test_round_trip_with_codec_and_delimiter(spark, scratch, codec, sep):
    src = fx.orders_lines(spark, SF_SMALL)
    path = f"{scratch}/lines"
    ln.write_lines(src, path, line_sep=sep, compression=codec)
    back = ln.read_lines(spark, path, line_sep=sep)
    assert back.exceptAll(src).count() == 0 and src.exceptAll(back).count() == 0


def test_long_line_filter_counts_bytes_and_delimiter(spark):
    rows = [("a" * 9,), ("a" * 10,), ("é" * 4,), ("é" * 5,), ("",)]
    df = spark.createDataFrame(rows, "value string")
    # keep when bytes + delimiter bytes < 11: 9 + 1 and 8 + 1 pass; 10 + 1 and 10 + 1 do not
    kept = sorted(r.value for r in ln.filter_long_lines(df, 11, "\n").collect())
    assert kept == sorted(["", "a" * 9, "é" * 4])
    assert ln.filter_long_lines(df, None).count() == len(rows)
