"""JSON messages to event rows and back."""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from ..functions import iso_timestamp, json_record

# Spark's own formats stop at milliseconds.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def parse_json_events(messages: DataFrame, schema: StructType, columns: list[str] | None = None,
                      time_column: str | None = "event_time",
                      require_time: bool = False) -> DataFrame:
    """Message ``value`` (text or bytes) to one column per schema field, time as timestamp.

    Malformed JSON gives a row of NULLs; a time without zone is one of the session's zone.
    ``columns`` narrows the schema, so other fields are never converted.  ``require_time`` drops rows
    whose time is missing or no timestamp.  With ``time_column=None`` no column is converted.
    """
    if columns is not None:
        schema = StructType([schema[name] for name in columns])
    events = messages.select(json_record(F.col("value").cast("string"), schema))
    if time_column is None:
        return events
    events = events.withColumn(time_column, iso_timestamp(F.col(time_column)))
    return events.where(F.col(time_column).isNotNull()) if require_time else events


def human_article_edits(events: DataFrame) -> DataFrame:
    """Edits of the main namespace not made by bots; NULL in any of the three drops the row."""
    return events.where(
        (F.col("namespace") == 0) & (F.col("bot") == F.lit(False)) & (F.col("event_type") == "edit")
    )


def encode_messages(events: DataFrame, key: str | None = "event_id") -> DataFrame:
    """Rows to ``key, value`` messages: the row as JSON text, NULL fields written out as null and
    times with their microseconds.

    The key is the text of column ``key``, NULL where that is NULL or where ``key`` is None.
    """
    message_key = F.lit(None) if key is None else F.col(key)
    return events.select(
        message_key.cast("string").alias("key"),
        F.to_json(F.struct("*"), JSON_OPTIONS).alias("value"),
    )
