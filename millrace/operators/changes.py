"""The raw change feed: server-sent event text to flat change rows."""

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, StructField, StructType

from ..functions import WHITESPACE, defaulted, sse_last, sse_lines, sse_values, strip
from ..schemas import RAW_CHANGE

_BLANK_LINE = f"\n[{WHITESPACE}]*\n"

# What a change event gets for a key that is missing.
MISSING_TYPE = "unknown"
MISSING_TEXT = ""
MISSING_NAMESPACE = 0
MISSING_FLAG = False
MISSING_TIME = 0

_DEFAULTED = ("type", "title", "user", "timestamp", "namespace", "comment", "bot", "minor", "wiki",
              "server_name")
_FRAMED = StructType([StructField("all", ArrayType(RAW_CHANGE)), StructField("end", BooleanType())])

# The seconds a calendar of the years 1 to 9999 can hold.
_FIRST_SECOND, _LAST_SECOND = -62135596800, 253402300799


def decode_sse(blocks: DataFrame, column: str = "value", event: str = "message") -> DataFrame:
    """Server-sent event text to ``event, id, data``, one row per event of the wanted type.

    ``blocks`` holds text of one or more events (``sources.read_sse``).  A line of white space only,
    as CRLF files have them, ends an event.  Several ``data:`` lines are joined by newlines, the last
    ``event:`` and ``id:`` line count, the type defaults to ``message``, other lines are ignored and
    an event without data yields nothing.  The last event of a file is decoded even with no blank
    line after it; one that is split over two files cannot be rejoined.
    """
    def decoded_lines(lines):
        return F.struct(
            F.coalesce(sse_last(lines, "event"), F.lit("message")).alias("event"),
            sse_last(lines, "id").alias("id"),
            strip(F.array_join(sse_values(lines, "data"), "\n")).alias("data"),
        )

    lines = F.transform(F.split(column, _BLANK_LINE), sse_lines)
    decoded = blocks.select(F.inline(F.transform(lines, decoded_lines)))
    return decoded.where((F.col("event") == event) & (F.col("data") != ""))


def normalise_recentchange(events: DataFrame, column: str = "data") -> DataFrame:
    """Raw change JSON to the flat fields of ``schemas.CHANGE``, event time as timestamp.

    A missing key gets its default, an explicit null stays NULL.  ``event_time`` is the instant of
    ``timestamp`` (second 0 if that is missing), ``edit_size`` is new minus old length.  Text that
    is no JSON object is dropped.

    The text is parsed once.  A second look, at its keys, is taken only where a field with a default
    came out NULL although its name is somewhere in the text.
    """
    text = F.col(column)
    # Spark's JSON functions stop reading after the first value.  In this frame whatever follows the
    # object makes a second element or keeps the end from being reached.
    framed = F.from_json(F.concat(F.lit('{"all":['), text, F.lit('],"end":true}')), _FRAMED)
    # Generators, so that the tests below do not parse the text once more.
    parsed = events.select(F.inline(F.array(F.struct(framed.alias("framed"), text.alias("text"))))) \
        .where((F.col("framed.end") == F.lit(True)) & (F.size("framed.all") == 1)) \
        .select(F.col("framed.all")[0].alias("raw"), "text").where(F.col("raw").isNotNull())

    # More names in the text than fields with a value: some field may be an explicit null.
    names = F.array(*[F.lit(f'"{name}"') for name in _DEFAULTED])
    named = F.size(F.filter(names, lambda name: F.contains("text", name)))
    filled = reduce(add, [F.col(f"raw.{name}").isNotNull().cast("int") for name in _DEFAULTED])
    unsure = (filled < len(_DEFAULTED)) & (
        F.contains("text", F.lit("\\u")) | (named > filled))
    keyed = parsed.select("raw", F.when(unsure, F.json_object_keys("text")).alias("keys"))

    def field(name, default):
        return defaulted(F.col(f"raw.{name}"), F.col("keys"), name, default)

    seconds = F.col("seconds")
    return keyed.withColumn("seconds", field("timestamp", MISSING_TIME)).select(
        F.col("raw.id").alias("event_id"),
        field("type", MISSING_TYPE).alias("event_type"),
        field("title", MISSING_TEXT).alias("page_title"),
        field("user", MISSING_TEXT).alias("user"),
        F.col("raw.timestamp").alias("timestamp"),
        F.timestamp_seconds(F.when(seconds.between(_FIRST_SECOND, _LAST_SECOND), seconds))
        .alias("event_time"),
        field("namespace", MISSING_NAMESPACE).alias("namespace"),
        field("comment", MISSING_TEXT).alias("comment"),
        field("bot", MISSING_FLAG).alias("bot"),
        field("minor", MISSING_FLAG).alias("minor"),
        field("wiki", MISSING_TEXT).alias("wiki"),
        field("server_name", MISSING_TEXT).alias("server_name"),
        F.col("raw.length.old").alias("length_old"),
        F.col("raw.length.new").alias("length_new"),
        F.try_subtract(F.col("raw.length.new"), F.col("raw.length.old")).alias("edit_size"),
    )
