import json
import time
from datetime import datetime
from pathlib import Path

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.operators import encode_messages, flatten_window, words
from millrace.plans import article_edit_counts, page_edit_counts
from millrace.schemas import KAFKA_MESSAGE
from millrace.sources import read_stream_output, stream_parquet
from millrace.streaming import (
    jdbc_batch_writer, kafka_sink, kafka_source, line_source, stream_sse, stream_to_console,
    stream_to_jdbc,
    stream_to_parquet,
)

ONCE = {"availableNow": True}


def put(spark, inbox, *times_and_pages, **fields):
    """Add one file of messages to a directory."""
    values = [
        json.dumps({"page_title": page, "event_time": f"2024-01-01T{time}Z", **fields}).encode()
        for time, page in times_and_pages
    ]
    spark.createDataFrame(
        [(None, v, "t", 0, i, None, 0) for i, v in enumerate(values)], KAFKA_MESSAGE
    ).coalesce(1).write.mode("append").parquet(str(inbox))
    time.sleep(0.05)  # files are taken in the order of their time stamps


def at(hour, minute):
    return datetime(2024, 1, 1, hour, minute)


def test_late_rows_are_dropped_and_open_windows_kept_back(spark, tmp_path):
    inbox, out = tmp_path / "inbox", str(tmp_path / "out")
    put(spark, inbox, ("00:00:10", "a"), ("00:20:00", "b"))
    put(spark, inbox, ("00:21:00", "b"))
    put(spark, inbox, ("00:00:20", "a"), ("00:40:00", "b"))
    source = stream_parquet(spark, str(inbox), KAFKA_MESSAGE, maxFilesPerTrigger=1)
    counts = page_edit_counts(source, "2 minutes", "10 minutes")
    query = stream_to_parquet(counts, out, str(tmp_path / "checkpoint"), trigger=ONCE)
    query.awaitTermination()
    assert rows(flatten_window(spark.read.parquet(out))) == [
        (at(0, 0), at(0, 2), "a", 1), (at(0, 20), at(0, 22), "b", 2)
    ]
    dropped = [
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress for operator in progress.stateOperators
    ]
    assert sum(dropped) == 1


def test_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    inbox, out, checkpoint = tmp_path / "inbox", str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        counts = page_edit_counts(stream_parquet(spark, str(inbox), KAFKA_MESSAGE))
        stream_to_parquet(counts, out, checkpoint, trigger=ONCE).awaitTermination()
        return rows(flatten_window(spark.read.parquet(out)))

    put(spark, inbox, ("00:00:10", "a"), ("00:05:00", "b"))
    assert run() == [(at(0, 0), at(0, 1), "a", 1)]
    assert run() == [(at(0, 0), at(0, 1), "a", 1)]
    put(spark, inbox, ("00:05:30", "b"), ("00:10:00", "c"))
    assert run() == [(at(0, 0), at(0, 1), "a", 1), (at(0, 5), at(0, 6), "b", 2)]


def test_batch_repeated_after_a_failure_is_written_once(spark, tmp_path):
    """As if the driver was lost after the files were written and before the batch was committed."""
    inbox, out, checkpoint = tmp_path / "inbox", str(tmp_path / "out"), tmp_path / "checkpoint"
    put(spark, inbox, ("00:00:10", "a"), ("00:00:20", "a"), ("00:05:00", "b"))

    def run():
        counts = page_edit_counts(stream_parquet(spark, str(inbox), KAFKA_MESSAGE))
        stream_to_parquet(counts, out, str(checkpoint), trigger=ONCE).awaitTermination()
        return rows(flatten_window(spark.read.parquet(out)))

    want = [(at(0, 0), at(0, 1), "a", 2)]
    assert run() == want
    last = max(int(f.name) for f in (checkpoint / "commits").iterdir() if f.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (checkpoint / "commits" / name).unlink(missing_ok=True)
    assert run() == want


def test_only_counted_events_close_windows(spark, tmp_path):
    inbox, out = tmp_path / "inbox", str(tmp_path / "out")
    human = {"namespace": 0, "bot": False, "event_type": "edit", "minor": True}
    put(spark, inbox, ("00:00:10", "a"), ("00:15:00", "a"), **human)
    put(spark, inbox, ("09:00:00", "a"), **{**human, "bot": True})
    counts = article_edit_counts(stream_parquet(spark, str(inbox), KAFKA_MESSAGE))
    stream_to_parquet(
        counts, out, str(tmp_path / "checkpoint"), ["window_start"], ONCE
    ).awaitTermination()
    written = spark.read.parquet(out)
    assert written.columns == ["window_end", "page_title", "edit_count", "minor_edits",
                               "major_edits", "window_start"]
    assert rows(written) == [(at(0, 2), "a", 1, 1, 0, at(0, 0))]
    assert [p.name for p in Path(out).iterdir() if p.is_dir() and "=" in p.name] == [
        "window_start=2024-01-01 00%3A00%3A00"
    ]
    assert read_stream_output(spark, out, ["window_start", "edit_count"], 1).count() == 1


def test_files_per_batch(spark, tmp_path):
    put(spark, tmp_path / "inbox", *[("00:00:10", f"p{i}") for i in range(50)], ("01:00:00", "z"))
    counts = page_edit_counts(stream_parquet(spark, str(tmp_path / "inbox"), KAFKA_MESSAGE))
    written = {}
    for name, files in (("scattered", None), ("gathered", 1)):
        out = tmp_path / name
        stream_to_parquet(
            flatten_window(counts), str(out), str(tmp_path / f"{name}-checkpoint"),
            ["window_start"], ONCE, files,
        ).awaitTermination()
        assert spark.read.parquet(str(out)).count() == 50
        written[name] = len(list(out.glob("window_start=*/*.parquet")))
    assert written["gathered"] == 1 < written["scattered"]


def test_append_needs_a_watermark(spark, tmp_path):
    put(spark, tmp_path / "inbox", ("00:00:10", "a"))
    stream = stream_parquet(spark, str(tmp_path / "inbox"), KAFKA_MESSAGE)
    with pytest.raises(AnalysisException):
        stream_to_parquet(stream.groupBy("topic").count(), str(tmp_path / "out"),
                          str(tmp_path / "checkpoint"), trigger=ONCE)


def test_processing_time_trigger(spark, tmp_path):
    put(spark, tmp_path / "inbox", ("00:00:10", "a"))
    stream = stream_parquet(spark, str(tmp_path / "inbox"), KAFKA_MESSAGE)
    query = stream_to_parquet(
        stream.select("topic"), str(tmp_path / "out"), str(tmp_path / "checkpoint"),
        trigger={"processingTime": "1 second"},
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).collect() == [("t",)]


def test_words_as_a_stream(spark, tmp_path):
    inbox, out = tmp_path / "inbox", str(tmp_path / "out")
    inbox.mkdir()
    (inbox / "lines.txt").write_text("a b\n\nc  d\n")
    lines = spark.readStream.text(str(inbox))
    stream_to_parquet(words(lines), out, str(tmp_path / "checkpoint"), trigger=ONCE).awaitTermination()
    assert rows(spark.read.parquet(out)) == [("",), ("",), ("a",), ("b",), ("c",), ("d",)]


def test_captured_feed_as_a_stream(spark, tmp_path):
    from millrace.plans import change_messages

    inbox, out = tmp_path / "inbox", str(tmp_path / "out")
    inbox.mkdir()
    (inbox / "feed.txt").write_text("data: {\"id\": 1}\n\ndata: {\n\nevent: x\ndata: {\"id\": 2}\n\n")
    (inbox / "a b.txt").write_text("".join(f"data: {{\"id\": {i}}}\n\n" for i in range(10, 400)))
    parts = []

    def write(events, epoch_id):
        parts.append(events.rdd.getNumPartitions())
        change_messages(events).write.mode("overwrite").parquet(f"{out}/batch={epoch_id}")

    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        stream_sse(spark, str(inbox), write, str(tmp_path / "checkpoint"), ONCE).awaitTermination()
        (inbox / "later.txt").write_text("data: {\"id\": 2}\n")
        stream_sse(spark, str(inbox), write, str(tmp_path / "checkpoint"), ONCE).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    keys = sorted(int(row.key) for row in spark.read.parquet(out).collect())
    assert keys == [1, 2, *range(10, 400)]
    assert len(parts) == 2


def rate(spark):
    """One partition, so that a continuous query holds one task slot."""
    return spark.readStream.format("rate").options(rowsPerSecond=5, numPartitions=1).load()


@pytest.mark.parametrize("trigger", [None, {"processingTime": "1 second"}, {"continuous": "1 second"}])
def test_console(spark, trigger):
    query = stream_to_console(rate(spark).select("value"), trigger, truncate=False)
    try:
        assert not query.awaitTermination(4)
        assert query.isActive and query.exception() is None
        # A continuous query reports no batches.
        assert trigger == {"continuous": "1 second"} or query.recentProgress
    finally:
        query.stop()


def test_continuous_trigger_takes_no_generator(spark):
    lines = rate(spark).select(F.col("value").cast("string"))
    with pytest.raises(AnalysisException):
        stream_to_console(words(lines), {"continuous": "1 second"})


def test_line_source(spark):
    lines = line_source(spark, "localhost", 9999)
    assert lines.isStreaming and lines.schema.simpleString() == "struct<value:string>"


class Recorder:
    """Stands in for a reader or writer whose connector is not at hand."""

    def __init__(self):
        self.calls, self.set = [], {}

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append(name)
            if name == "option":
                self.set[args[0]] = args[1]
            elif name == "options":
                self.set.update(kwargs)
            elif args:
                self.set[name] = args[0]
            return self
        return call


class FakeFrame:
    isStreaming = False

    def __init__(self, schema):
        self.write, self.schema = Recorder(), schema


def test_kafka_source_options():
    class Session:
        readStream = Recorder()

    kafka_source(Session, "b:1", "edits", "earliest", 1000, 64, failOnDataLoss="false")
    assert Session.readStream.set == {
        "format": "kafka", "kafka.bootstrap.servers": "b:1", "subscribe": "edits",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": 1000, "minPartitions": 64,
        "failOnDataLoss": "false",
    }
    Session.readStream = Recorder()
    kafka_source(Session, "b:1", "edits")
    assert Session.readStream.set["startingOffsets"] == "latest"
    assert "maxOffsetsPerTrigger" not in Session.readStream.set


def test_kafka_sink_options(spark, tmp_path):
    frame = FakeFrame(None)
    kafka_sink(frame, "b:1", "edits", **{"kafka.acks": "all"})
    assert frame.write.calls[-1] == "save"
    assert frame.write.set == {"format": "kafka", "kafka.bootstrap.servers": "b:1",
                               "topic": "edits", "kafka.acks": "all"}
    message = encode_messages(spark.createDataFrame([(1,)], "event_id long"))
    with pytest.raises(AnalysisException, match="kafka"):  # reaches Spark, which lacks the connector
        kafka_sink(message, "b:1", "edits")


def test_jdbc_writer(spark):
    frame = FakeFrame(spark.createDataFrame([(1,)], "n int").schema)
    jdbc_batch_writer("jdbc:x", "counts", "a.Driver", "me", "secret", max_connections=4,
                      batchsize="5000")(frame, 3)
    assert frame.write.calls[-1] == "save"
    assert frame.write.set == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "counts", "user": "me", "password": "secret",
        "driver": "a.Driver", "numPartitions": "4", "batchsize": "5000",
        "mode": "append",
    }


def test_stream_to_jdbc_writes_flat_batches(spark, tmp_path, monkeypatch):
    """Each batch ends in a JDBC write; here that is caught, as there is no database."""
    from pyspark.sql import DataFrameWriter

    put(spark, tmp_path / "inbox", ("00:00:10", "a"), ("00:05:00", "b"))
    counts = page_edit_counts(stream_parquet(spark, str(tmp_path / "inbox"), KAFKA_MESSAGE))
    out = str(tmp_path / "out")
    monkeypatch.setattr(
        DataFrameWriter, "save", lambda self: self._df.write.mode("append").parquet(out)
    )
    stream_to_jdbc(counts, "jdbc:x", "counts", str(tmp_path / "checkpoint"), "a.Driver",
                   ONCE).awaitTermination()
    assert rows(spark.read.parquet(out)) == [(at(0, 0), at(0, 1), "a", 1)]


def test_a_repeated_batch_can_be_told(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    out = str(tmp_path / "out")
    monkeypatch.setattr(
        DataFrameWriter, "save", lambda self: self._df.write.mode("append").parquet(out)
    )
    write = jdbc_batch_writer("jdbc:x", "counts", "a.Driver", epoch_column="epoch")
    for epoch in (3, 3, 4):
        write(spark.createDataFrame([(1,)], "n int"), epoch)
    assert rows(spark.read.parquet(out)) == [(1, 3), (1, 3), (1, 4)]
