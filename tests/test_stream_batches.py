"""Committed batches, late rows, open windows and compaction."""

from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import windowed_counts
from millrace.sources import stream_parquet
from millrace.streaming import (
    batch_ledger, batch_writer, compact_output, late_splitter, open_windows, read_committed,
    read_compacted, stream_in_batches, stream_to_parquet,
)

START = datetime(2024, 1, 1)


def events(spark, *minutes):
    """One event per minute given; None is an event without time."""
    values = [(m if m is None else START + timedelta(minutes=m), f"p{m}", i)
              for i, m in enumerate(minutes)]
    return spark.createDataFrame(values, "event_time timestamp, page string, n int")


def test_a_batch_counts_once(spark, tmp_path):
    path = str(tmp_path / "out")
    write = batch_writer(spark, path)
    for _ in range(3):
        write(events(spark, 1, 2), 0)
    write(events(spark, 3, None), 1)
    # A broken attempt without a line in the ledger, and one of a second driver with a line.
    events(spark, 7).write.parquet(f"{path}/data/batch=1/attempt=0/late=false")
    events(spark, 3, None).write.parquet(f"{path}/data/batch=1/attempt=zz/late=false")
    spark.createDataFrame([(1, "zz", 2, 0)], "batch long, attempt string, row_count long, late_count "
                          "long").write.json(f"{path}/ledger/batch=1-zz")
    found = read_committed(spark, path)
    assert found.columns == ["event_time", "page", "n", "batch"]
    assert sorted((r.batch, r.page) for r in found.collect()) == [
        (0, "p1"), (0, "p2"), (1, "p3"), (1, "pNone")]
    assert sorted((r.batch, r.row_count) for r in batch_ledger(spark, path).collect()) == [
        (0, 2), (1, 2)]


def test_empty_batches(spark, tmp_path):
    path = str(tmp_path / "out")
    write = batch_writer(spark, path)
    write(events(spark, 1).where("false"), 0)
    write(events(spark, 1), 1)
    assert read_committed(spark, path).count() == 1
    assert [r.row_count for r in batch_ledger(spark, path).orderBy("batch").collect()] == [0, 1]


def test_late_rows_go_aside(spark, tmp_path):
    """Two-minute windows, ten minutes of delay, judged by the highest time of batches before."""
    path = str(tmp_path / "out")
    write = late_splitter(spark, path)
    write(events(spark, 0, 20), 0)                  # watermark 10
    write(events(spark, 7, 8, 9, 10, None, 40), 1)  # windows that ended at 8 and 10 are closed
    write(events(spark, 29, 28, 27, 3), 2)          # watermark 30
    write(events(spark, 29, 28, 27, 3), 2)
    on_time = sorted(r.page for r in read_committed(spark, path).collect())
    late = sorted(r.page for r in read_committed(spark, path, late=True).collect())
    assert on_time == sorted(["p0", "p20", "p10", "pNone", "p40"])
    assert late == sorted(["p7", "p8", "p9", "p29", "p28", "p27", "p3"])
    assert read_committed(spark, path, late=None).count() == len(on_time) + len(late)
    assert [r.late_count for r in batch_ledger(spark, path).orderBy("batch").collect()] == [0, 3, 4]


def test_time_keeps_microseconds_and_negative_times(spark, tmp_path):
    path = str(tmp_path / "out")
    write = late_splitter(spark, path, width="1 second", delay="0 seconds")
    old = spark.createDataFrame([(datetime(1969, 12, 31, 23, 59, 58, 1),)], "event_time timestamp")
    write(spark.createDataFrame([(datetime(1969, 12, 31, 23, 59, 59, 999_999),)],
                                "event_time timestamp"), 0)
    write(old, 1)
    (entry,) = batch_ledger(spark, path).where("batch = 0").collect()
    assert entry.max_time.microsecond == 999_999
    assert read_committed(spark, path, late=True).count() == 1


def run(counts, path, checkpoint, **options):
    stream_to_parquet(counts, path, checkpoint, trigger={"availableNow": True},
                      **options).awaitTermination()


def test_closed_open_and_late_rows_are_all(spark, tmp_path):
    inbox, path, aside = (str(tmp_path / name) for name in ("in", "out", "aside"))
    write, came = late_splitter(spark, aside, width="2 minutes"), 0
    for minutes in ((0, 1, 20), (21, 22), (0, 2, 14, 40)):
        events(spark, *minutes).write.mode("append").parquet(inbox)
        came += len(minutes)
        stream = stream_parquet(spark, inbox)
        run(windowed_counts(stream, "page", width="2 minutes", delay="10 minutes"), path,
            str(tmp_path / "counts"))
        stream_in_batches(stream_parquet(spark, inbox), write, str(tmp_path / "split"),
                          {"availableNow": True}).awaitTermination()
    closed = spark.read.parquet(path).agg(F.sum("count")).first()[0]
    still = open_windows(spark, str(tmp_path / "counts"), ["count"])
    assert still.columns == ["window_start", "window_end", "page", "count"]
    late = read_committed(spark, aside, late=True)
    assert sorted(r.page for r in late.collect()) == ["p0", "p2"]
    assert closed + still.agg(F.sum("count")).first()[0] + late.count() == came
    first = open_windows(spark, str(tmp_path / "counts"), ["count"], batch=0)
    assert first.agg(F.sum("count")).first()[0] == 3
    with pytest.raises(ValueError):
        open_windows(spark, str(tmp_path / "counts"), ["count", "more"])


def test_compaction_while_the_stream_goes_on(spark, tmp_path):
    inbox, path, target = (str(tmp_path / name) for name in ("in", "out", "small"))
    stream = None
    for step, start in enumerate((0, 100, 200)):
        events(spark, *range(start, start + 60)).withColumn("page", F.lit("a:b %")) \
            .repartition(6).write.mode("append").parquet(inbox)
        stream = stream_parquet(spark, inbox, maxFilesPerTrigger=2)
        run(stream.select("event_time", "page", "n"), path, str(tmp_path / "checkpoint"),
            partition_by=["page"])
        if step < 2:
            assert compact_output(spark, path, target, partition_by=["page"]) >= 3
            assert compact_output(spark, path, target, partition_by=["page"]) == 0
    whole = spark.read.parquet(path)
    found = read_compacted(spark, path, target)
    assert sorted(found.columns) == sorted(whole.columns)
    assert rows(found.select("event_time", "page", "n")) == rows(
        whole.select("event_time", "page", "n"))
    assert found.count() == 180 and len(found.inputFiles()) < len(whole.inputFiles())
