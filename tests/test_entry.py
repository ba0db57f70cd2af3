"""The driver contract, and the stored table as a folder of several files."""

import os

import __spark_entry__ as entry
from tests.helpers import rows, run
from wakeline.functions.timecols import HOUR, with_watermark
from wakeline.operators import windows
from wakeline.sources import activity as src

SF = "/root/testdata/sf0.001"


def test_flagship(spark):
    board = entry.entry(spark)
    assert board.columns == ["window_start_ms", "window_end_ms", "rank", "product_id", "count"]
    assert board.count() > 0


def test_table_of_several_files_as_a_stream(spark, tmp_path):
    """In time order and a few files per micro-batch: the same windows as from the stored table."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    parts = spark.read.parquet(f"{SF}/events.parquet").repartitionByRange(4, "ts")
    parts.write.parquet(f"{tmp_path}/events.parquet")
    names = sorted(f for f in os.listdir(f"{tmp_path}/events.parquet") if f.endswith(".parquet"))
    assert len(names) == 4
    for i, name in enumerate(names):
        os.utime(f"{tmp_path}/events.parquet/{name}", (1_700_000_000 + i * 10,) * 2)
    stored = windows.tumbling_counts(src.activity(spark, str(tmp_path)), HOUR)
    mark = src.activity(spark, str(tmp_path)).agg({"ts_ms": "max"}).first()[0] - HOUR
    for files in (1, None):
        events = with_watermark(src.activity(spark, str(tmp_path), streaming=True, files_per_batch=files), HOUR)
        got = run(windows.tumbling_counts(events, HOUR), tmp_path, name=f"files-{files}")
        assert rows(got, "*") == rows(stored.filter(f"window_end_ms <= {mark}"), "*")


def test_the_stream_reads_no_neighbours(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    for name in ("events.parquet", "events.parquet_old"):
        events.coalesce(1).write.parquet(f"{tmp_path}/{name}")
    got = run(src.activity(spark, str(tmp_path), streaming=True), tmp_path, name="neighbours")
    assert got.count() == events.count()
