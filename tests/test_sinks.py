import logging
from pathlib import Path

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.sinks import write_csv, write_parquet
from millrace.workspace import checkpoint_root


def files(path, suffix):
    return sorted(Path(path).rglob(f"*.{suffix}"))


def test_csv_has_header_and_one_file_if_asked(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "foo"), (2, "bar")], "id int, val string").repartition(4)
    write_csv(df, path, num_files=1)
    (only,) = files(path, "csv")
    assert sorted(only.read_text().splitlines()) == ["1,foo", "2,bar", "id,val"]
    write_csv(df, path)
    assert rows(spark.read.csv(path, header=True)) == [("1", "foo"), ("2", "bar")]


def test_one_csv_file_is_written_by_many_tasks(spark, tmp_path):
    """As text and read back, in all modes; each of the 16 tasks stores its own rows."""
    path, shared = str(tmp_path / "one file"), Path(checkpoint_root(spark).removeprefix("file:"))
    df = spark.range(0, 40_000, 1, 16).select("id", F.when(F.col("id") % 3 > 0, F.concat(
        F.lit('a "b", é\\'), F.col("id"))).alias("val"))
    before = {*shared.glob("csv-pieces-*")}
    write_csv(df, path, num_files=1)
    pieces = [len([*new.glob("part-*.csv")]) for new in {*shared.glob("csv-pieces-*")} - before]
    assert pieces == [16]
    (only,) = files(path, "csv")
    write_csv(df.coalesce(1), str(tmp_path / "plain"))
    (plain,) = files(str(tmp_path / "plain"), "csv")
    assert only.read_bytes() == plain.read_bytes()
    assert [p.name for p in Path(path).iterdir() if not p.name.startswith(".")
            and p != only] == ["_SUCCESS"]
    back = spark.read.schema(df.schema).csv(path, header=True)
    assert back.count() == 40_000 and back.exceptAll(df).count() == 0
    write_csv(df, path, mode="ignore", num_files=1)
    assert files(path, "csv") == [only]
    with pytest.raises(AnalysisException):
        write_csv(df, path, mode="error", num_files=1)
    write_csv(df, path, mode="append", num_files=1)
    assert len(files(path, "csv")) == 2
    assert spark.read.schema(df.schema).csv(path, header=True).count() == 80_000
    write_csv(df.where("false"), f"file://{path}", num_files=1)
    (only,) = files(path, "csv")
    assert only.read_text() == "id,val\n"


def test_large_pieces_are_copied_in_stretches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("millrace.sinks.files.COPIED", 1000)
    df = spark.range(0, 3000, 1, 2).select("id", F.lit("é,x").alias("val"))
    path, whole = str(tmp_path / "one"), ["id,val", *(f'{i},"é,x"' for i in range(3000))]
    write_csv(df, path, num_files=1)
    (only,) = files(path, "csv")
    assert only.read_text().splitlines() == whole


def test_csv_sorted_across_files(spark, tmp_path):
    path = str(tmp_path / "out")
    write_csv(spark.range(1000).repartition(7), path, num_files=3, sort_by=["id"])
    parts = [[int(line) for line in part.read_text().splitlines()[1:]] for part in files(path, "csv")]
    assert 1 < len(parts) <= 3
    assert sum(parts, []) == list(range(1000))


def test_failed_write_is_logged_and_raised(spark, tmp_path, caplog):
    path = str(tmp_path / "out")
    write_csv(spark.range(1), path)
    with caplog.at_level(logging.INFO), pytest.raises(AnalysisException):
        write_csv(spark.range(1), path, mode="error")
    assert "failed" in caplog.text
    with caplog.at_level(logging.INFO):
        write_csv(spark.range(1), path)
    assert "wrote CSV" in caplog.text


def by_date(spark, values):
    return spark.createDataFrame(values, "id int, day string").select(
        "id", F.to_date("day").alias("date")
    )


def test_parquet_by_date_overwrites_all_partitions(spark, tmp_path):
    path = str(tmp_path / "out")
    write_parquet(by_date(spark, [(1, "1995-01-01"), (2, "1995-01-02"), (3, None)]), path,
                  partition_by=["date"])
    names = {p.name for p in Path(path).iterdir() if p.is_dir()}
    assert names == {"date=1995-01-01", "date=1995-01-02", "date=__HIVE_DEFAULT_PARTITION__"}
    assert spark.read.parquet(path).where("date is null").collect() == [(3, None)]
    write_parquet(by_date(spark, [(4, "1995-01-02")]), path, partition_by=["date"])
    assert {p.name for p in Path(path).iterdir() if p.is_dir()} == {"date=1995-01-02"}


def test_partitioned_write_makes_few_files(spark, tmp_path):
    days = spark.range(800).select(
        "id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int"))
        .alias("date")
    ).repartition(16)
    clustered, scattered = str(tmp_path / "clustered"), str(tmp_path / "scattered")
    write_parquet(days, clustered, partition_by=["date"])
    write_parquet(days, scattered, partition_by=["date"], cluster=False)
    assert len(files(clustered, "parquet")) == 5
    assert len(files(scattered, "parquet")) > 5
    assert rows(spark.read.parquet(clustered)) == rows(spark.read.parquet(scattered))


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    hot = spark.range(0, 400_000, 1, 8).select(
        F.xxhash64("id").alias("id"), F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("part")
    )
    path = str(tmp_path / "out")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500k")
    try:
        write_parquet(hot, path, partition_by=["part"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(files(f"{path}/part=0", "parquet")) > 1
    assert spark.read.parquet(path).count() == 400_000


def test_partition_filter_reaches_the_scan(spark, tmp_path, plan):
    path = str(tmp_path / "out")
    write_parquet(by_date(spark, [(1, "1995-01-01"), (2, "1995-01-02")]), path, partition_by=["date"])
    text = plan(spark.read.parquet(path).where("date = '1995-01-01'"))
    assert "PartitionFilters: [isnotnull(date" in text
