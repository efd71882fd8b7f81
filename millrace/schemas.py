"""Fixed schemas and message layouts (fixed values: names, order and types are part of the data)."""

from pyspark.sql import types as T

RATINGS = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("item_id", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

MOVIES = T.StructType([
    T.StructField("movie_id", T.IntegerType()),
    T.StructField("movie_title", T.StringType()),
])

DATED_MOVIES = T.StructType([
    T.StructField("movie_id", T.IntegerType()),
    T.StructField("movie_title", T.StringType()),
    T.StructField("date", T.DateType()),
])

# One simulated page edit, JSON in the message value.
EDIT = T.StructType([
    T.StructField("page_title", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("edit_size", T.IntegerType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("edit_id", T.StringType()),
])

# One normalised change event, JSON in the message value.
CHANGE = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("page_title", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("namespace", T.IntegerType()),
    T.StructField("comment", T.StringType()),
    T.StructField("bot", T.BooleanType()),
    T.StructField("minor", T.BooleanType()),
    T.StructField("wiki", T.StringType()),
    T.StructField("server_name", T.StringType()),
    T.StructField("length_old", T.IntegerType()),
    T.StructField("length_new", T.IntegerType()),
    T.StructField("edit_size", T.IntegerType()),
])

# The keys read from a raw change event before it is normalised.
RAW_CHANGE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("namespace", T.IntegerType()),
    T.StructField("comment", T.StringType()),
    T.StructField("bot", T.BooleanType()),
    T.StructField("minor", T.BooleanType()),
    T.StructField("wiki", T.StringType()),
    T.StructField("server_name", T.StringType()),
    T.StructField("length", T.StructType([
        T.StructField("old", T.IntegerType()),
        T.StructField("new", T.IntegerType()),
    ])),
])

# What a Kafka source delivers; a frame of this shape can stand in for a broker.
KAFKA_MESSAGE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])
