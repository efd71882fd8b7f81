"""The same counts as streams: messages lie in a directory, closed windows are appended to Parquet.

Messages that are there at the start make one batch, so no row is late and the result is exact.
"""

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from millrace.operators import flatten_window, parse_json_events, windowed_counts
from millrace.plans import article_edit_counts, page_edit_counts
from millrace.schemas import EDIT
from millrace.sources import read_stream_output, stream_parquet
from millrace.streaming import (
    batch_writer, compact_output, late_splitter, open_windows, read_committed, read_compacted,
    stream_in_batches, stream_to_parquet,
)
from millrace.workspace import scratch_path

from .edits import (
    EDITS, EDIT_COUNTS, HUMAN_EDITS, change_messages, counts_sql, edit_messages, numbered,
)
from .registry import query, without_zone


def run_once(counts, path, checkpoint, **options):
    stream_to_parquet(
        counts, path, checkpoint, trigger={"availableNow": True}, **options
    ).awaitTermination()


def streamed(spark, messages, plan, **options):
    """Run ``plan`` over a directory of messages until all is read; returns the output path."""
    inbox, path = scratch_path(spark, "inbox"), scratch_path(spark, "counts")
    messages.write.parquet(inbox)
    run_once(plan(stream_parquet(spark, inbox)), path, scratch_path(spark, "checkpoint"), **options)
    return path


PAGE_COUNTS = counts_sql(EDITS, "1 minute", "page_title", "2 minutes")
ARTICLE_COUNTS = counts_sql(HUMAN_EDITS, "6 hours", "page_title", "10 minutes", EDIT_COUNTS)


@query("stream_page_counts", PAGE_COUNTS)
def stream_page_counts(spark, sf_dir):
    path = streamed(spark, edit_messages(spark, sf_dir), page_edit_counts)
    return without_zone(flatten_window(spark.read.parquet(path)), "window_start", "window_end")


@query("stream_article_counts", ARTICLE_COUNTS)
def stream_article_counts(spark, sf_dir):
    """Partitioned by window start, with few files in each partition."""
    path = streamed(
        spark, change_messages(spark, sf_dir),
        lambda messages: article_edit_counts(messages, width="6 hours"),
        partition_by=["window_start"], files_per_batch=2,
    )
    return without_zone(spark.read.parquet(path), "window_start", "window_end")


@query("read_stream_output", f"""
    SELECT * FROM ({PAGE_COUNTS})
    ORDER BY window_start DESC, "count" DESC, page_title DESC LIMIT 10
""")
def stream_latest_pages(spark, sf_dir):
    """The ten latest and largest counts the stream has written, sorted by a nested field."""
    path = streamed(spark, edit_messages(spark, sf_dir), page_edit_counts)
    latest = read_stream_output(spark, path, ["window.start", "count", "page_title"], 10)
    return without_zone(flatten_window(latest), "window_start", "window_end")


@query("read_stream_output_flat", f"SELECT * FROM ({ARTICLE_COUNTS}) "
       "ORDER BY window_start DESC, edit_count DESC, page_title DESC LIMIT 10")
def stream_latest_articles(spark, sf_dir):
    path = streamed(
        spark, change_messages(spark, sf_dir),
        lambda messages: article_edit_counts(messages, width="6 hours"),
    )
    latest = read_stream_output(spark, path, ["window_start", "edit_count", "page_title"], 10)
    return without_zone(latest, "window_start", "window_end")


DAY_COUNTS = counts_sql("SELECT ts AS event_time, event_type AS page_title FROM events", "6 hours",
                        "page_title", "10 minutes")


def run_in_steps(spark, sf_dir, *steps):
    """One run of the query per step, each of which adds the messages of a condition on ``ts`` and
    goes on from the checkpoint of the run before."""
    messages = numbered(spark, sf_dir).select(
        F.to_json(F.struct(F.col("event_type").alias("page_title"), F.col("iso").alias("event_time")))
        .alias("value"), "ts",
    )
    inbox, path = scratch_path(spark, "inbox"), scratch_path(spark, "counts")
    checkpoint = scratch_path(spark, "checkpoint")
    for condition in steps:
        messages.where(condition).drop("ts").write.mode("append").parquet(inbox)
        counts = page_edit_counts(stream_parquet(spark, inbox), "6 hours", "10 minutes")
        run_once(counts, path, checkpoint)
    return without_zone(flatten_window(spark.read.parquet(path)), "window_start", "window_end")


@query("stream_resumed", DAY_COUNTS)
def stream_resumed(spark, sf_dir):
    """Windows open at the break are counted over both runs."""
    return run_in_steps(spark, sf_dir, "ts < '2024-01-16 01:30:00'", "ts >= '2024-01-16 01:30:00'")


@query("stream_late_rows", DAY_COUNTS)
def stream_late_rows(spark, sf_dir):
    """The last run brings the first ten days once more; all of that is late and dropped."""
    return run_in_steps(
        spark, sf_dir, "ts < '2024-01-11'", "ts >= '2024-01-11' AND ts < '2024-01-21'",
        "ts < '2024-01-11' OR ts >= '2024-01-21'",
    )


@query("stream_replayed", PAGE_COUNTS)
def stream_replayed(spark, sf_dir):
    """All messages again from the start, with a second checkpoint and output."""
    inbox = scratch_path(spark, "inbox")
    edit_messages(spark, sf_dir).write.parquet(inbox)
    for _ in range(2):
        path = scratch_path(spark, "counts")
        run_once(page_edit_counts(stream_parquet(spark, inbox)), path,
                 scratch_path(spark, "checkpoint"))
    return without_zone(flatten_window(spark.read.parquet(path)), "window_start", "window_end")


@query("stream_processing_time", PAGE_COUNTS)
def stream_processing_time(spark, sf_dir):
    """A timed trigger, stopped when all that is there has been read."""
    inbox, path = scratch_path(spark, "inbox"), scratch_path(spark, "counts")
    edit_messages(spark, sf_dir).write.parquet(inbox)
    running = stream_to_parquet(
        page_edit_counts(stream_parquet(spark, inbox)), path, scratch_path(spark, "checkpoint"),
        trigger={"processingTime": "1 second"},
    )
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return without_zone(flatten_window(spark.read.parquet(path)), "window_start", "window_end")


ONCE = {"availableNow": True}


def edits_of(messages):
    return parse_json_events(messages, EDIT, ["page_title", "user", "edit_size", "event_time"],
                             require_time=True)


@query("stream_repeated_batches", EDITS)
def stream_repeated_batches(spark, sf_dir):
    """Each batch is handed over twice and comes out once."""
    inbox, path = scratch_path(spark, "inbox"), scratch_path(spark, "batches")
    edit_messages(spark, sf_dir).repartition(4).write.parquet(inbox)
    write = batch_writer(spark, path)

    def twice(batch, number):
        write(batch, number)
        write(batch, number)

    stream_in_batches(edits_of(stream_parquet(spark, inbox, maxFilesPerTrigger=1)), twice,
                      scratch_path(spark, "checkpoint"), ONCE).awaitTermination()
    return without_zone(read_committed(spark, path).drop("batch"), "event_time")


#: Events by time, so that a stream that takes one file after the other has no late rows.
IN_ORDER = ("ts < '2024-01-11'", "ts >= '2024-01-11' AND ts < '2024-01-21'", "ts >= '2024-01-21'")


def day_messages(spark, sf_dir):
    return numbered(spark, sf_dir).select(
        F.to_json(F.struct(F.col("event_type").alias("page_title"), F.col("iso").alias("event_time")))
        .alias("value"), "ts",
    )


def broken_run(counts, path, checkpoint, breaks):
    """Run until a batch named in ``breaks`` breaks the query, where it does so for the first time."""
    write = batch_writer(counts.sparkSession, path)

    def broken(batch, number):
        kind = breaks.pop(number, None)
        if kind == "before the ledger":
            batch.write.parquet(f"{path}/data/batch={number}/attempt=0/late=false")
        else:
            write(batch, number)
        if kind:
            raise RuntimeError(kind)

    try:
        stream_in_batches(counts, broken, checkpoint, ONCE).awaitTermination()
    except StreamingQueryException:
        return False
    return True


@query("stream_recovered", DAY_COUNTS)
def stream_recovered(spark, sf_dir):
    """Two batches break the run, one with its output half done, one between output and commit; the
    runs after them give what an unbroken one gives."""
    inbox, path = scratch_path(spark, "inbox"), scratch_path(spark, "batches")
    checkpoint = scratch_path(spark, "checkpoint")
    for condition in IN_ORDER:
        day_messages(spark, sf_dir).where(condition).drop("ts").coalesce(1) \
            .write.mode("append").parquet(inbox)
    breaks = {1: "before the ledger", 2: "after the ledger"}
    done = False
    while not done:
        counts = page_edit_counts(stream_parquet(spark, inbox, maxFilesPerTrigger=1), "6 hours",
                                  "10 minutes")
        done = broken_run(counts, path, checkpoint, breaks)
    assert not breaks
    found = flatten_window(read_committed(spark, path).drop("batch"))
    return without_zone(found, "window_start", "window_end")


OPEN_COUNTS = ARTICLE_COUNTS.replace("<= (SELECT", "> (SELECT")


@query("stream_open_windows", OPEN_COUNTS)
def stream_open_windows(spark, sf_dir):
    """The counts of windows that no later event has closed yet, from the state."""
    inbox, checkpoint = scratch_path(spark, "inbox"), scratch_path(spark, "checkpoint")
    change_messages(spark, sf_dir).write.parquet(inbox)
    run_once(article_edit_counts(stream_parquet(spark, inbox), width="6 hours"),
             scratch_path(spark, "counts"), checkpoint)
    counted = open_windows(spark, checkpoint, ["edit_count", "minor_edits", "major_edits"])
    return without_zone(counted, "window_start", "window_end")


ALL_DAYS = "SELECT ts AS event_time, event_type AS page_title FROM events"
AGAIN = ALL_DAYS + " WHERE ts < '2024-01-11'"


@query("stream_rows_accounted", f"""
    SELECT 'closed' AS kind, * FROM ({DAY_COUNTS})
    UNION ALL SELECT 'open', * FROM ({DAY_COUNTS.replace("<= (SELECT", "> (SELECT")})
    UNION ALL SELECT 'late', * FROM ({counts_sql(AGAIN, "6 hours", "page_title")})
""")
def stream_rows_accounted(spark, sf_dir):
    """The third run brings the first ten days once more, too late: what was written, what is still
    open and what was put aside make up all that came in."""
    inbox, path = scratch_path(spark, "inbox"), scratch_path(spark, "counts")
    aside, checkpoints = scratch_path(spark, "batches"), [
        scratch_path(spark, "checkpoint") for _ in range(2)]
    write = late_splitter(spark, aside, width="6 hours")
    for condition in (*IN_ORDER[:2], f"{IN_ORDER[0]} OR {IN_ORDER[2]}"):
        rows = day_messages(spark, sf_dir).where(condition).drop("ts")
        rows.write.mode("append").parquet(inbox)
        messages = stream_parquet(spark, inbox)
        run_once(page_edit_counts(messages, "6 hours", "10 minutes"), path, checkpoints[0])
        edits = parse_json_events(messages, EDIT, ["page_title", "event_time"], require_time=True)
        stream_in_batches(edits, write, checkpoints[1], ONCE).awaitTermination()
    late = windowed_counts(read_committed(spark, aside, late=True), "page_title", width="6 hours")
    parts = {
        "closed": flatten_window(spark.read.parquet(path)),
        "open": open_windows(spark, checkpoints[0], ["count"]), "late": flatten_window(late),
    }
    columns = ["kind", "window_start", "window_end", "page_title", "count"]
    found = None
    for kind, part in parts.items():
        part = part.withColumn("kind", F.lit(kind)).select(columns)
        found = part if found is None else found.unionByName(part)
    return without_zone(found, "window_start", "window_end")


@query("stream_compacted", DAY_COUNTS)
def stream_compacted(spark, sf_dir):
    """Compacted after each of two runs, and read with the files of a third run as they are."""
    inbox, path = scratch_path(spark, "inbox"), scratch_path(spark, "counts")
    checkpoint, target = scratch_path(spark, "checkpoint"), scratch_path(spark, "compacted")
    for step, condition in enumerate(IN_ORDER):
        day_messages(spark, sf_dir).where(condition).drop("ts").write.mode("append").parquet(inbox)
        counts = flatten_window(page_edit_counts(stream_parquet(spark, inbox), "6 hours",
                                                 "10 minutes"))
        run_once(counts, path, checkpoint, partition_by=["window_start"])
        if step < 2:
            compact_output(spark, path, target, partition_by=["window_start"])
    found = read_compacted(spark, path, target)
    return without_zone(found, "window_start", "window_end")
