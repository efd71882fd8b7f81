from datetime import date

import pytest
from conftest import rows
from pyspark.errors import AnalysisException

from millrace.operators import decode_sse, lift_nested_field, words
from millrace.schemas import DATED_MOVIES, MOVIES, RATINGS
from millrace.sources import (
    job_param, read_csv_inferred, read_delimited, read_json, read_sse, read_stream_output,
)


def write(tmp_path, text, name="data.txt"):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


@pytest.mark.parametrize("delimiter", ["::", "\t"])
def test_delimited_ratings(spark, tmp_path, delimiter):
    lines = ["1::10::4.5::978300760", "2::10::bad::978300761", "3::11::::978300762", "4::12"]
    path = write(tmp_path, "\n".join(lines).replace("::", delimiter))
    df = read_delimited(spark, path, RATINGS, delimiter)
    assert df.schema == RATINGS
    assert rows(df) == [
        (1, 10, 4.5, 978300760), (2, 10, None, 978300761), (3, 11, None, 978300762),
        (4, 12, None, None),
    ]


def test_columns_beyond_the_schema_are_dropped(spark, tmp_path):
    path = write(tmp_path, "1|One (1995)|01-Jan-1995||x|0\n2|Two\n3\n")
    assert rows(read_delimited(spark, path, MOVIES, "|")) == [
        (1, "One (1995)"), (2, "Two"), (3, None)
    ]


def test_date_pattern(spark, tmp_path):
    path = write(tmp_path, "1|a|01-Jan-1995\n2|b|1-Jan-1995\n3|c|\n4|d|1995-01-01\n")
    df = read_delimited(spark, path, DATED_MOVIES, "|", date_format="d-MMM-yyyy")
    day = date(1995, 1, 1)
    assert rows(df) == [(1, "a", day), (2, "b", day), (3, "c", None), (4, "d", None)]


def test_inferred_csv(spark, tmp_path):
    path = write(tmp_path, "id;name;score\n1;a;1.5\n2;b;\n")
    df = read_csv_inferred(spark, path, delimiter=";")
    assert dict(df.dtypes) == {"id": "int", "name": "string", "score": "double"}
    assert rows(df) == [(1, "a", 1.5), (2, "b", None)]
    text = read_csv_inferred(spark, path, header=False, infer_schema=False, delimiter=";")
    assert set(dict(text.dtypes).values()) == {"string"} and text.count() == 3


BUSINESS = """{"name": "a", "attributes": {"AgesAllowed": "21plus", "Wifi": "no"}}
{"name": "b", "attributes": {"Wifi": "free"}}
{"name": "c", "attributes": null}
{"name": "d"}
"""


def test_inferred_json_and_lifted_field(spark, tmp_path):
    df = read_json(spark, write(tmp_path, BUSINESS))
    assert df.schema["attributes"].dataType.names == ["AgesAllowed", "Wifi"]
    lifted = lift_nested_field(df, "attributes.AgesAllowed")
    assert lifted.columns == ["attributes", "name", "attributes_AgesAllowed"]
    assert rows(lifted.drop("attributes")) == [("a", "21plus")]
    every = lift_nested_field(df, "attributes.AgesAllowed", "ages", keep_null=True)
    assert rows(every.select("name", "ages")) == [
        ("a", "21plus"), ("b", None), ("c", None), ("d", None)
    ]


def test_broken_json_line(spark, tmp_path):
    path = write(tmp_path, BUSINESS + '{"name": "e", "attr\n')
    df = read_json(spark, path)
    assert "_corrupt_record" in df.columns
    assert lift_nested_field(df, "attributes.AgesAllowed").count() == 1


def test_field_no_record_has_needs_a_schema(spark, tmp_path):
    path = write(tmp_path, BUSINESS)
    with pytest.raises(AnalysisException):
        lift_nested_field(read_json(spark, path), "attributes.Parking")
    schema = "name string, attributes struct<Parking: string>"
    assert lift_nested_field(read_json(spark, path, schema), "attributes.Parking").count() == 0


def test_lifted_field_is_pruned_and_tested_in_the_scan(spark, tmp_path, plan):
    path = str(tmp_path / "business")
    read_json(spark, write(tmp_path, BUSINESS)).write.parquet(path)
    lifted = lift_nested_field(spark.read.parquet(path), "attributes.AgesAllowed")
    text = plan(lifted.select("name", "attributes_AgesAllowed"))
    assert "PushedFilters: [IsNotNull(attributes.AgesAllowed)]" in text
    assert "ReadSchema: struct<attributes:struct<AgesAllowed:string>,name:string>" in text


def test_words(spark):
    lines = spark.createDataFrame([(1, "a b  c"), (2, ""), (3, None)], "id int, value string")
    assert rows(words(lines, keep=("id",))) == [(1, ""), (1, "a"), (1, "b"), (1, "c"), (2, "")]


def test_large_event_text_is_split_between_blocks(spark, tmp_path):
    path = write(tmp_path, "".join(f"id: {i}\ndata: {'x' * 50}{i}\n\n" for i in range(2000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 4
        got = rows(decode_sse(read_sse(spark, path)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted(
        (("message", str(i), "x" * 50 + str(i)) for i in range(2000)), key=lambda row: row[1]
    )


def test_job_param(spark):
    spark.conf.set("spark.app.ratings_path", "/data/ratings ")
    assert job_param(spark, "ratings_path") == "/data/ratings"
    assert job_param(spark, "batch_id", "N/A") == "N/A"
    with pytest.raises(KeyError, match="spark.app.nothing"):
        job_param(spark, "nothing")


def test_stream_output_sorted_by_nested_field(spark, tmp_path):
    path = str(tmp_path / "out")
    spark.sql("""
        SELECT named_struct('start', s) AS window, page, n AS count
        FROM VALUES (1, 'a', 5), (2, 'd', 1), (2, 'b', 1), (2, 'c', 3) AS t(s, page, n)
    """).write.parquet(path)
    ordered = read_stream_output(spark, path, ["window.start", "count"])
    assert [row.page for row in ordered.collect()] == ["c", "b", "d", "a"]
    assert read_stream_output(spark, path, ["window.start", "count"], 1).collect()[0].page == "c"
    assert read_stream_output(spark, path).count() == 4
