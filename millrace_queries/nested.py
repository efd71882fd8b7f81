"""Nested JSON: ``events`` with its ``props`` as a struct, which sign-ups do not have."""

from pyspark.sql import functions as F

from millrace.operators import lift_nested_field
from millrace.sources import read_json
from millrace.workspace import scratch_path

from .registry import query, table

SCHEMA = "event_id long, event_type string, attributes struct<k: long>"


def nested_lines(spark, sf_dir):
    path = scratch_path(spark, "json")
    attributes = F.when(F.col("event_type") != "signup", F.from_json("props", "k long"))
    table(spark, sf_dir, "events").select(
        "event_id", "event_type", attributes.alias("attributes")
    ).write.json(path)
    return path


@query("read_json", """
    SELECT event_id, event_type,
           CASE WHEN event_type <> 'signup' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k
    FROM events
""")
def read_json_inferred(spark, sf_dir):
    events = read_json(spark, nested_lines(spark, sf_dir))
    return events.select("event_id", "event_type", F.col("attributes.k").alias("k"))


LIFTED = """
    SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS attributes_k
    FROM events WHERE event_type <> 'signup'
"""


@query("lift_nested_field", LIFTED)
def lift_nested_json(spark, sf_dir):
    events = read_json(spark, nested_lines(spark, sf_dir), SCHEMA)
    return lift_nested_field(events, "attributes.k").drop("attributes")


@query("lift_nested_field_parquet", LIFTED)
def lift_nested_parquet(spark, sf_dir):
    """The same from Parquet, where the not-null test and the field choice reach the scan."""
    path = scratch_path(spark, "parquet")
    read_json(spark, nested_lines(spark, sf_dir), SCHEMA).write.parquet(path)
    return lift_nested_field(spark.read.parquet(path), "attributes.k").drop("attributes")
