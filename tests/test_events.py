import json
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import (
    encode_messages, flatten_window, human_article_edits, parse_json_events, windowed_counts,
    windowed_edit_counts,
)
from millrace.plans import article_edit_counts, page_edit_counts
from millrace.schemas import CHANGE, EDIT, KAFKA_MESSAGE

EDIT_COLUMNS = ["page_title", "user", "edit_size", "event_time"]


def messages(spark, *values):
    """Frame of the shape a broker delivers."""
    texts = [v if v is None or isinstance(v, str) else json.dumps(v) for v in values]
    return spark.createDataFrame(
        [(None, None if t is None else t.encode(), "topic", 0, i, None, 0)
         for i, t in enumerate(texts)],
        KAFKA_MESSAGE,
    )


def edit(**fields):
    return {"page_title": "p", "user": "u", "edit_size": 1, "edit_id": "e",
            "event_time": "2024-01-01T00:00:10.5Z", **fields}


def test_edits_without_a_proper_time_are_dropped(spark):
    no_time = edit()
    del no_time["event_time"]
    source = messages(
        spark, edit(), no_time, edit(event_time=""), edit(event_time="soon"),
        edit(event_time=None), "{broken", "", None,
    )
    parsed = parse_json_events(source, EDIT, EDIT_COLUMNS, require_time=True)
    assert parsed.columns == EDIT_COLUMNS
    assert rows(parsed) == [("p", "u", 1, datetime(2024, 1, 1, 0, 0, 10, 500000))]
    assert parse_json_events(source, EDIT).count() == 8


@pytest.mark.parametrize("size", ["7", 7.0, 1 << 40, None, True])
def test_values_of_another_type_are_null(spark, size):
    parsed = parse_json_events(messages(spark, edit(edit_size=size)), EDIT, EDIT_COLUMNS)
    assert [(r.page_title, r.edit_size) for r in parsed.collect()] == [("p", None)]


def test_time_zones_of_event_times(spark):
    times = ["2024-01-01T02:00:00+02:00", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00"]
    parsed = parse_json_events(messages(spark, *[edit(event_time=t) for t in times]), EDIT)
    assert {r.event_time for r in parsed.collect()} == {datetime(2024, 1, 1)}


def change(**fields):
    return {"event_id": 1, "event_type": "edit", "page_title": "p", "namespace": 0, "bot": False,
            "minor": False, "event_time": "2024-01-01T00:00:10", **fields}


def test_human_article_edits(spark):
    source = messages(
        spark, change(), change(event_id=2, bot=True), change(event_id=3, bot=None),
        change(event_id=4, namespace=1), change(event_id=5, event_type="log"),
        change(event_id=6, event_type=None), change(event_id=7, namespace=None), "{broken",
        change(event_id=8, minor=None),
    )
    kept = human_article_edits(parse_json_events(source, CHANGE))
    assert kept.columns == CHANGE.names
    assert sorted(row.event_id for row in kept.collect()) == [1, 8]


def test_json_is_parsed_once(spark, plan):
    text = plan(article_edit_counts(messages(spark, change())))
    assert text.count("from_json") == 1


def test_messages_round_trip(spark):
    df = spark.createDataFrame(
        [(7, "é \"x\"", None, datetime(2024, 1, 1, 0, 0, 1, 123456))],
        "event_id long, title string, size int, at timestamp",
    )
    (message,) = encode_messages(df).collect()
    assert message.key == "7"
    assert json.loads(message.value) == {
        "event_id": 7, "title": "é \"x\"", "size": None, "at": "2024-01-01T00:00:01.123456Z"
    }
    back = parse_json_events(encode_messages(df), df.schema, time_column=None)
    assert back.collect() == df.collect()
    keys = encode_messages(df.withColumn("event_id", F.lit(None).cast("long"))).collect()
    assert keys[0].key is None
    assert encode_messages(df, key=None).collect()[0].key is None


def test_windows_have_their_start_and_not_their_end(spark):
    at = [(0, 0), (0, 59), (1, 0)]
    source = messages(
        spark, *[edit(event_time=f"2024-01-01T00:{m:02}:{s:02}Z") for m, s in at],
        edit(page_title="q", event_time="2024-01-01T00:00:59.999Z"),
    )
    counts = page_edit_counts(source)
    assert counts.columns == ["window", "page_title", "count"]
    flat = flatten_window(counts)
    assert flat.columns == ["window_start", "window_end", "page_title", "count"]
    first, second, third = (datetime(2024, 1, 1, 0, m) for m in (0, 1, 2))
    assert rows(flat) == sorted(
        [(first, second, "p", 2), (first, second, "q", 1), (second, third, "p", 1)], key=str
    )


def test_unknown_minor_is_neither(spark):
    source = messages(
        spark, change(), change(minor=True), change(minor=None), change(bot=True),
        change(event_time="never"),
    )
    counts = article_edit_counts(source)
    assert counts.columns == [
        "window_start", "window_end", "page_title", "edit_count", "minor_edits", "major_edits"
    ]
    assert rows(counts) == [
        (datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 2), "p", 3, 1, 1)
    ]


def test_rows_without_time_are_not_counted(spark):
    schema = "event_time timestamp, page_title string, minor boolean"
    df = spark.createDataFrame([(None, "p", True)], schema)
    assert windowed_counts(df, "page_title").count() == 0
    assert windowed_edit_counts(df).count() == 0


def test_counts_are_combined_before_the_shuffle(spark, plan):
    text = plan(page_edit_counts(messages(spark, edit())))
    assert text.index("functions=[count(1)]") < text.index("Exchange hashpartitioning")
    assert text.index("Exchange hashpartitioning") < text.index("partial_count(1)")
