import json
import random
from datetime import datetime

import pytest
from conftest import rows

from millrace.operators import decode_sse, normalise_recentchange
from millrace.plans import change_messages
from millrace.schemas import CHANGE
from millrace.sources import read_sse

DEFAULTS = {
    "event_id": None, "event_type": "unknown", "page_title": "", "user": "", "timestamp": None,
    "event_time": datetime(1970, 1, 1), "namespace": 0, "comment": "", "bot": False,
    "minor": False, "wiki": "", "server_name": "", "length_old": None, "length_new": None,
    "edit_size": None,
}


def decoded(spark, *blocks):
    return rows(decode_sse(spark.createDataFrame([(b,) for b in blocks], "value string")))


def test_blocks(spark):
    assert decoded(
        spark,
        ": only a comment",
        "id: 1\nevent: message",                          # no data
        "event: message\nid: 2\ndata: {\"a\":\ndata:  1}",  # two data lines
        "id: 3\ndata: x",                                 # no type
        "event: other\nid: 4\ndata: x",                   # another type
        "event: other\nevent: message\nid: 5\nid: 6\ndata:x\nretry: 9",  # the last one counts
        "event:\nid: 7\ndata: x",                         # an empty type is no message
        "id: 8\ndata:\ndata:   ",                         # empty data
        "  data: y  \n\tid:9\t",                          # white space around
        "data: 10\n\n\n",
        "", None,
    ) == sorted([
        ("message", "2", "{\"a\":\n1}"), ("message", "3", "x"), ("message", "6", "x"),
        ("message", "9", "y"), ("message", None, "10"),
    ], key=lambda r: [(v is not None, str(v)) for v in r])


def test_lines_of_white_space_end_an_event(spark):
    assert decoded(spark, "data: 1\n \t\ndata: 2\n \r\n\n\xa0\ndata: 3") == [
        ("message", None, "1"), ("message", None, "2"), ("message", None, "3")
    ]


def test_captured_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b": hi\n\nid: 1\ndata: a\n\n\n\nid: 2\ndata: b\n\nid: 3\ndata: c")
    (tmp_path / "b.txt").write_bytes(b"id: 4\r\ndata: d\r\ndata: e\r\n\r\nid: 5\r\ndata: f\r\n\r\n")
    want = [("message", "1", "a"), ("message", "2", "b"), ("message", "3", "c"),
            ("message", "4", "d\ne"), ("message", "5", "f")]
    assert rows(decode_sse(read_sse(spark, str(tmp_path)))) == want
    whole = spark.read.text(str(tmp_path), wholetext=True)
    assert whole.count() == 2 and rows(decode_sse(whole)) == want


def test_bytes_that_are_no_text_are_replaced(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b'data: {"id": 1, "title": "a\xffb \xc3\xa9"}\n\n')
    (change,) = normalise_recentchange(decode_sse(read_sse(spark, str(tmp_path)))).collect()
    assert (change.event_id, change.page_title) == (1, "a\ufffdb é")


def normalised(spark, *texts):
    texts = [t if t is None or isinstance(t, str) else json.dumps(t) for t in texts]
    df = normalise_recentchange(spark.createDataFrame([(t,) for t in texts], "data string"))
    assert df.columns == CHANGE.names
    return [row.asDict() for row in df.collect()]


def test_missing_keys_get_defaults_and_nulls_stay(spark):
    keys = ["id", "type", "title", "user", "timestamp", "namespace", "comment", "bot", "minor",
            "wiki", "server_name", "length"]
    missing, null = normalised(spark, {}, dict.fromkeys(keys))
    assert missing == DEFAULTS
    assert null == dict.fromkeys(DEFAULTS)


def test_complete_change(spark):
    (change,) = normalised(spark, {
        "id": 5, "type": "edit", "title": "T", "user": "u", "timestamp": 1704067200,
        "namespace": 1, "comment": "c", "bot": True, "minor": True, "wiki": "w",
        "server_name": "s", "length": {"old": 10, "new": 4}, "other": {"id": 6, "title": "no"},
    })
    assert change == {
        "event_id": 5, "event_type": "edit", "page_title": "T", "user": "u",
        "timestamp": 1704067200, "event_time": datetime(2024, 1, 1), "namespace": 1,
        "comment": "c", "bot": True, "minor": True, "wiki": "w", "server_name": "s",
        "length_old": 10, "length_new": 4, "edit_size": -6,
    }


def test_last_of_equal_keys_counts(spark):
    (change,) = normalised(spark, '{"id": 1, "title": "a", "title": "b", "id": 2}')
    assert (change["event_id"], change["page_title"]) == (2, "b")


def test_edit_size_needs_both_lengths(spark):
    sizes = normalised(
        spark, {"length": {"old": 1}}, {"length": {"new": 1}}, {"length": None}, {"length": 5},
        {"length": {"old": -(2 ** 31), "new": 2 ** 31 - 1}}, {"length": {"old": 0, "new": 0}},
    )
    assert [(c["length_old"], c["length_new"], c["edit_size"]) for c in sizes] == [
        (1, None, None), (None, 1, None), (None, None, None), (None, None, None),
        (-(2 ** 31), 2 ** 31 - 1, None), (0, 0, 0),
    ]


def test_times_no_calendar_holds_are_null(spark):
    changes = normalised(spark, {"timestamp": 2 ** 62}, {"timestamp": -1}, {"timestamp": "x"})
    assert [(c["timestamp"], c["event_time"]) for c in changes] == [
        (2 ** 62, None), (-1, datetime(1969, 12, 31, 23, 59, 59)), (None, None)
    ]


def test_text_that_is_no_json_object_is_dropped(spark):
    assert normalised(
        spark, "{\"id\": 1", "{\"id\": 1} more", "{\"id\": 1},{\"id\": 2}", "[1]", "[{\"id\": 1}]",
        "7", "null", "", "text", None,
    ) == []


def test_messages_from_text(spark):
    blocks = spark.createDataFrame(
        [("data: {\"id\": 3, \"title\": null}",), ("data: {\"title\": \"t\"}",), ("data: {",)],
        "value string",
    )
    by_key = {m.key: json.loads(m.value) for m in change_messages(blocks).collect()}
    assert by_key.keys() == {"3", None}
    assert by_key["3"] == {**DEFAULTS, "event_id": 3, "page_title": None,
                           "event_time": "1970-01-01T00:00:00.000000Z"}
    assert by_key[None]["page_title"] == "t"


@pytest.mark.parametrize("split_bytes", [50, 997, 1 << 20])
def test_random_events_survive_their_notation(spark, tmp_path, split_bytes):
    """Events written with random line ends, blanks, comments and split data are decoded as they
    were, wherever their file is split."""
    draw = random.Random(split_bytes)

    def noise():
        return draw.choice(["", "", ": ping\n", "retry: 10\n", "unknown line\n", ":\n"])

    def blanks():
        return draw.choice(["", " ", "\t", "  "])

    events, text = [], ""
    for number in range(300):
        words = ["".join(draw.choices("ab:é{}\" 0", k=draw.randint(1, 12))).strip() or "x"
                 for _ in range(draw.randint(1, 4))]
        event_id = str(number) if draw.random() < 0.8 else None
        kind = draw.choice(["message", None, "other"])
        lines = [f"{blanks()}data:{blanks()}{word}{blanks()}\n" for word in words]
        if event_id is not None:
            lines.insert(draw.randint(0, len(lines)), f"id:{blanks()}{event_id}\n")
        if kind is not None:
            lines.insert(draw.randint(0, len(lines)), f"event:{blanks()}{kind}{blanks()}\n")
        block = "".join(noise() + line for line in lines)
        end = draw.choice(["\n", "\n\n", "\n\n\n", " \n", "\t \n\n", "\r\n"])
        text += (block.replace("\n", "\r\n") if draw.random() < 0.3 else block) + end
        if kind != "other":
            events.append(("message", event_id, "\n".join(words)))
    (tmp_path / "feed.txt").write_bytes(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = [tuple(row) for row in decode_sse(read_sse(spark, str(tmp_path))).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(got, key=repr) == sorted(events, key=repr)


@pytest.mark.parametrize("lines", ["1", "3"])
def test_events_over_batches(spark, tmp_path, lines):
    """Events that go over the batches of a task, and files without or with blank lines only."""
    (tmp_path / "a.txt").write_text("".join(f"id: {i}\ndata: a\ndata: {i}\n\n" for i in range(40)))
    (tmp_path / "b.txt").write_text("\n\n\n")
    (tmp_path / "c.txt").write_text("")
    (tmp_path / "d.txt").write_text("data: x\ndata: y")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", lines)
    try:
        got = rows(decode_sse(read_sse(spark, str(tmp_path))))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == rows(decode_sse(spark.read.text(str(tmp_path), wholetext=True)))
    assert len(got) == 41


def test_only_ends_of_splits_are_shuffled(spark, tmp_path, plan):
    (tmp_path / "a.txt").write_text("data: x\n\n" * 100)
    shown = plan(read_sse(spark, str(tmp_path)))
    assert shown.count("MapInArrow") == 2 and shown.index("Exchange") > shown.index("MapInArrow")


def test_keys_are_looked_at_only_where_needed(spark):
    """Names inside of other values, escaped names, and text after the object."""
    found = normalised(
        spark, '{"comment": "the \\"title\\" of it", "id": 1}', '{"\\u0074itle": null, "id": 2}',
        '{"length": {"title": null}, "id": 3}', '{"id": 4}]', '{"id": 5}] {}', ' {"id": 6} ',
        '{"id": 7}, "title": {}', '{"type": null, "id": 8, "type": "x"}')
    assert {c["event_id"]: c["page_title"] for c in found} == {1: "", 2: None, 3: "", 6: "", 8: ""}
    assert [c["event_type"] for c in found if c["event_id"] == 8] == ["x"]
