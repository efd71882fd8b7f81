"""JSON messages made from ``events``, parsed and counted per window as batch frames."""

from pyspark.sql import functions as F

from millrace.operators import (
    encode_messages, flatten_window, human_article_edits, parse_json_events, windowed_counts,
    windowed_edit_counts,
)
from millrace.plans import article_edit_counts, page_edit_counts
from millrace.schemas import CHANGE, EDIT

from .registry import query, table, without_zone

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def numbered(spark, sf_dir):
    """``events`` with the number in its JSON properties and ISO time text."""
    return table(spark, sf_dir, "events").select(
        "*",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.date_format("ts", ISO).alias("iso"),
    )


def edit_messages(spark, sf_dir):
    """One message per event; errors are broken JSON, sign-ups have no proper time."""
    edits = numbered(spark, sf_dir).select(
        F.col("event_type").alias("page_title"),
        F.concat(F.lit("u"), "user_id").alias("user"),
        F.col("k").alias("edit_size"),
        F.when(F.col("event_type") != "signup", F.col("iso")).otherwise("soon")
        .alias("event_time"),
        F.concat(F.lit("edit-"), "event_id").alias("edit_id"),
    )
    messages = encode_messages(edits, key="edit_id")
    broken = F.col("value").startswith('{"page_title":"error"')
    value = F.when(broken, F.concat(F.lit("not json "), "value")).otherwise(F.col("value"))
    return messages.select(F.col("key").cast("binary"), value.cast("binary").alias("value"))


EDITS = """
    SELECT event_type AS page_title, 'u' || user_id AS "user",
           CAST(json_extract(props, '$.k') AS INTEGER) AS edit_size, ts AS event_time
    FROM events WHERE event_type NOT IN ('error', 'signup')
"""


def change_messages(spark, sf_dir):
    """One message per event, with bots, logs, other namespaces and unknown flags among them."""
    n = numbered(spark, sf_dir)
    changes = n.select(
        "event_id",
        F.when(n.event_type == "signup", "log").otherwise("edit").alias("event_type"),
        F.concat(F.lit("page-"), "user_id").alias("page_title"),
        F.concat(F.lit("u"), "user_id").alias("user"),
        F.unix_timestamp("ts").alias("timestamp"),
        n.iso.alias("event_time"),
        F.when(n.k < 80, 0).otherwise(1).alias("namespace"),
        n.event_type.alias("comment"),
        F.when(n.k < 20, True).when(n.k >= 25, False).alias("bot"),
        F.when(n.value < 20, True).when(n.value < 80, False).alias("minor"),
        F.lit("xxwiki").alias("wiki"),
        F.lit("xx.example.org").alias("server_name"),
        n.k.alias("length_old"),
        n.user_id.cast("int").alias("length_new"),
        (n.user_id.cast("int") - n.k).alias("edit_size"),
    )
    messages = encode_messages(changes)
    return messages.select(F.col("key").cast("binary"), F.col("value").cast("binary"))


CHANGES = """
    SELECT event_id, CASE WHEN event_type = 'signup' THEN 'log' ELSE 'edit' END AS event_type,
           'page-' || user_id AS page_title, 'u' || user_id AS "user",
           CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp", ts AS event_time,
           CASE WHEN k < 80 THEN 0 ELSE 1 END AS namespace, event_type AS comment,
           CASE WHEN k < 20 THEN TRUE WHEN k >= 25 THEN FALSE END AS bot,
           CASE WHEN value < 20 THEN TRUE WHEN value < 80 THEN FALSE END AS minor,
           'xxwiki' AS wiki, 'xx.example.org' AS server_name, k AS length_old,
           CAST(user_id AS INTEGER) AS length_new, CAST(user_id - k AS INTEGER) AS edit_size
    FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
"""
HUMAN_EDITS = f"""
    SELECT * FROM ({CHANGES}) WHERE namespace = 0 AND bot = FALSE AND event_type = 'edit'
"""


def counts_sql(source, width, key, closed_after=None, counts='count(*) AS "count"'):
    """Counts per window and key; with ``closed_after`` only those a stream has emitted."""
    closed = ""
    if closed_after:
        closed = f"""
            HAVING time_bucket(INTERVAL '{width}', event_time) + INTERVAL '{width}'
                   <= (SELECT max(event_time) FROM ({source})) - INTERVAL '{closed_after}'
        """
    return f"""
        SELECT time_bucket(INTERVAL '{width}', event_time) AS window_start,
               time_bucket(INTERVAL '{width}', event_time) + INTERVAL '{width}' AS window_end,
               {key}, {counts}
        FROM ({source}) GROUP BY time_bucket(INTERVAL '{width}', event_time), {key} {closed}
    """


EDIT_COUNTS = """
    count(*) AS edit_count, count(CASE WHEN minor THEN 1 END) AS minor_edits,
    count(CASE WHEN NOT minor THEN 1 END) AS major_edits
"""


@query("encode_messages", """
    SELECT CAST(event_id AS VARCHAR) AS key,
           '{"event_id":' || event_id || ',"event_type":"' || event_type || '","user_id":' ||
           user_id || ',"error_user":' ||
           CASE WHEN event_type = 'error' THEN CAST(user_id AS VARCHAR) ELSE 'null' END || '}'
           AS value
    FROM events
""")
def encode_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "user_id",
        F.when(F.col("event_type") == "error", F.col("user_id")).alias("error_user"),
    )
    return encode_messages(events)


@query("parse_json_events", EDITS)
def parse_edits(spark, sf_dir):
    edits = parse_json_events(
        edit_messages(spark, sf_dir), EDIT, ["page_title", "user", "edit_size", "event_time"],
        require_time=True,
    )
    return without_zone(edits, "event_time")


@query("parse_json_events_changes", CHANGES)
def parse_changes(spark, sf_dir):
    changes = parse_json_events(change_messages(spark, sf_dir), CHANGE)
    return without_zone(changes, "event_time")


@query("human_article_edits", HUMAN_EDITS)
def human_edits(spark, sf_dir):
    changes = parse_json_events(change_messages(spark, sf_dir), CHANGE)
    return without_zone(human_article_edits(changes), "event_time")


@query("windowed_counts", counts_sql(
    "SELECT ts AS event_time, event_type FROM events", "6 hours", "event_type",
))
def window_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp"), "event_type")
    counts = windowed_counts(events, "event_type", time_column="ts", width="6 hours")
    return without_zone(flatten_window(counts), "window_start", "window_end")


@query("windowed_edit_counts", counts_sql(
    "SELECT ts AS event_time, event_type, value < 50 AS minor FROM events", "2 minutes",
    "event_type", counts=EDIT_COUNTS,
))
def window_edit_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp"), "event_type", (F.col("value") < 50).alias("minor")
    )
    counts = windowed_edit_counts(events, "event_type", "ts")
    return without_zone(counts, "window_start", "window_end")


@query("page_edit_counts", counts_sql(EDITS, "1 minute", "page_title"))
def page_counts(spark, sf_dir):
    counts = flatten_window(page_edit_counts(edit_messages(spark, sf_dir)))
    return without_zone(counts, "window_start", "window_end")


@query("article_edit_counts", counts_sql(HUMAN_EDITS, "2 minutes", "page_title", counts=EDIT_COUNTS))
def article_counts(spark, sf_dir):
    counts = article_edit_counts(change_messages(spark, sf_dir))
    return without_zone(counts, "window_start", "window_end")


@query("messages_keep_microseconds", "SELECT event_id, ts FROM events")
def microseconds_round_trip(spark, sf_dir):
    """Event times to JSON messages and back, equal to the microsecond."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    back = parse_json_events(encode_messages(events), events.schema, time_column=None)
    return without_zone(back, "ts")
