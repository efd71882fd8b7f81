"""Change feed made from ``events``: written as server-sent event text, decoded and normalised."""

from pyspark.sql import functions as F

from millrace.operators import decode_sse, normalise_recentchange
from millrace.plans import article_edit_counts, change_messages
from millrace.sources import read_sse, stream_parquet
from millrace.streaming import stream_sse, stream_to_parquet
from millrace.workspace import scratch_path

from .edits import EDIT_COUNTS, counts_sql, numbered
from .registry import query, without_zone

# One layout per event type, filled from columns: complete, keys missing, explicit nulls over two
# data lines, broken JSON, and an event of another type.
DATA = {
    "click": '{{"id":{event_id},"type":"edit","title":"Page {user_id}","user":"u{user_id}",'
             '"timestamp":{seconds},"namespace":0,"comment":"c","bot":false,"minor":true,'
             '"wiki":"xxwiki","server_name":"xx.example.org","length":{{"old":{k},"new":{user_id}}}}}',
    "view": '{{"id":{event_id},"type":"edit","title":"Page {user_id}","timestamp":{seconds}}}',
    "purchase": '{{"id":{event_id},"title":null,"timestamp":null,"bot":null,\n'
                '"length":{{"old":{k}}}}}',
    "error": '{{"id":{event_id},"type":',
    "signup": '{{"id":{event_id}}}',
}
COLUMNS = {"event_id": "event_id", "user_id": "user_id", "k": "k", "seconds": "seconds"}


def by_type(render, otherwise):
    """``render`` of each layout, chosen by the event type."""
    chosen = F
    for event_type, layout in DATA.items():
        chosen = chosen.when(F.col("event_type") == event_type, render(layout))
    return chosen.otherwise(otherwise)


def filled(layout):
    """The layout as an expression over the columns it names."""
    text = layout.format(**{name: f"\0{name}\0" for name in COLUMNS})
    parts = text.split("\0")
    return F.concat(*[
        F.col(part).cast("string") if i % 2 else F.lit(part) for i, part in enumerate(parts)
    ])


def filled_sql(layout):
    text = layout.format(**{name: f"\0{name}\0" for name in COLUMNS})
    parts = text.split("\0")
    return " || ".join(
        f"CAST({part} AS VARCHAR)" if i % 2 else "'" + part + "'" for i, part in enumerate(parts)
    )


def capture(spark, sf_dir):
    """Write the feed; returns the path."""
    path = scratch_path(spark, "feed")
    rows = numbered(spark, sf_dir).withColumn("seconds", F.unix_timestamp("ts"))
    name = F.when(F.col("event_type") == "signup", "event: other\n").otherwise("")
    data = F.concat(F.lit("data: "), F.replace(by_type(filled, None), F.lit("\n"), F.lit("\ndata: ")))
    rows.select(
        F.concat(F.lit(": comment\n"), name, F.lit("id: "), "event_id", F.lit("\n"), data)
    ).write.option("lineSep", "\n\n").text(path)
    return path


ROWS = """
    SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
           CAST(floor(epoch(ts)) AS BIGINT) AS seconds
    FROM events
"""
LAYOUTS_SQL = " ".join(
    f"WHEN event_type = '{event_type}' THEN {filled_sql(layout)}"
    for event_type, layout in DATA.items()
)
DECODED = f"""
    SELECT 'message' AS event, CAST(event_id AS VARCHAR) AS id, CASE {LAYOUTS_SQL} END AS data
    FROM ({ROWS}) WHERE event_type <> 'signup'
"""
NORMALISED = """
    SELECT event_id, CASE WHEN purchase THEN 'unknown' ELSE 'edit' END AS event_type,
           CASE WHEN NOT purchase THEN 'Page ' || user_id END AS page_title,
           CASE WHEN click THEN 'u' || user_id ELSE '' END AS "user",
           CASE WHEN NOT purchase THEN seconds END AS "timestamp",
           CASE WHEN NOT purchase THEN date_trunc('second', ts) END AS event_time,
           0 AS namespace, CASE WHEN click THEN 'c' ELSE '' END AS comment,
           CASE WHEN NOT purchase THEN FALSE END AS bot, click AS minor,
           CASE WHEN click THEN 'xxwiki' ELSE '' END AS wiki,
           CASE WHEN click THEN 'xx.example.org' ELSE '' END AS server_name,
           CASE WHEN click OR purchase THEN k END AS length_old,
           CASE WHEN click THEN CAST(user_id AS INTEGER) END AS length_new,
           CASE WHEN click THEN CAST(user_id - k AS INTEGER) END AS edit_size
    FROM (SELECT *, event_type = 'click' AS click, event_type = 'purchase' AS purchase
          FROM (""" + ROWS + """) WHERE event_type IN ('click', 'view', 'purchase'))
"""
COUNTED = f"""
    SELECT * FROM ({NORMALISED}) WHERE namespace = 0 AND bot = FALSE AND event_type = 'edit'
"""


@query("decode_sse", DECODED)
def decode_feed(spark, sf_dir):
    return decode_sse(read_sse(spark, capture(spark, sf_dir)))


@query("normalise_recentchange", NORMALISED)
def normalise_feed(spark, sf_dir):
    changes = normalise_recentchange(decode_sse(read_sse(spark, capture(spark, sf_dir))))
    return without_zone(changes, "event_time")


@query("feed_counts", counts_sql(COUNTED, "2 minutes", "page_title", counts=EDIT_COUNTS))
def feed_counts(spark, sf_dir):
    """From captured text through keyed messages to article counts."""
    messages = change_messages(read_sse(spark, capture(spark, sf_dir)))
    return without_zone(article_edit_counts(messages), "window_start", "window_end")


@query("stream_feed_counts", counts_sql(COUNTED, "6 hours", "page_title", "10 minutes", EDIT_COUNTS))
def stream_feed_counts(spark, sf_dir):
    """The same over a stream of captured files, with the messages of each batch in a folder."""
    path, inbox = scratch_path(spark, "counts"), scratch_path(spark, "inbox")

    def write(events, epoch_id):
        change_messages(events).write.mode("overwrite").parquet(f"{inbox}/batch={epoch_id}")

    stream_sse(spark, capture(spark, sf_dir), write, scratch_path(spark, "checkpoint"),
               {"availableNow": True}).awaitTermination()
    messages = stream_parquet(spark, inbox)
    stream_to_parquet(
        article_edit_counts(messages, width="6 hours"), path, scratch_path(spark, "checkpoint"),
        trigger={"availableNow": True},
    ).awaitTermination()
    return without_zone(spark.read.parquet(path), "window_start", "window_end")
