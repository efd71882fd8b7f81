from collections import Counter
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import Window, functions as F

from millrace.operators import rank_within, ranking
from millrace.workspace import stored


def brute_force(values, ascending=True):
    """One plus the number of rows of the group that sort before; NULL sorts as smallest."""
    def key(value):
        return (value is not None, value)

    out = []
    for row_id, group, value in values:
        before = [
            v for _, g, v in values
            if g == group and (key(v) < key(value) if ascending else key(v) > key(value))
        ]
        out.append((row_id, group, value, len(before) + 1))
    return sorted(out, key=lambda row: [(v is not None, str(v)) for v in row])


def in_parts(spark, settings, parts):
    """Let ranges be as many parts as asked for, however small."""
    for key, value in (("spark.sql.shuffle.partitions", parts),
                       ("spark.sql.adaptive.coalescePartitions.enabled", "false")):
        before = spark.conf.get(key)
        spark.conf.set(key, value)
        settings.callbacks.append((spark, key, before))


@pytest.fixture
def settings():
    class Settings:
        callbacks = []

    yield Settings
    for session, key, before in Settings.callbacks:
        session.conf.set(key, before)


VALUES = (
    [(i, "a", i % 7) for i in range(60)]
    + [(100 + i, "b", i) for i in range(5)]
    + [(200 + i, None, i % 2) for i in range(30)]
    + [(300 + i, "c", None) for i in range(30)]
    + [(400, "c", 3), (401, "c", 3), (402, "c", 1)]
)
SCHEMA = "id int, g string, v int"


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("parts", [1, 3, 8, 60])
def test_same_result_whether_groups_are_split_or_not(spark, ascending, parts, settings):
    in_parts(spark, settings, parts)
    df = spark.createDataFrame(VALUES, SCHEMA).repartition(5)
    ranked = rank_within(df, ["g"], ["v"], [ascending])
    assert ranked.columns == ["id", "g", "v", "rank"]
    assert rows(ranked) == brute_force(VALUES, ascending)


def test_two_keys_two_orders_in_mixed_direction(spark):
    values = [(i, i % 2, "xyz"[i % 3], date(2024, 1, 1 + i % 11), float(i % 5)) for i in range(200)]
    df = spark.createDataFrame(values, "id int, g int, h string, d date, v double")
    order = Window.partitionBy("g", "h").orderBy(F.desc("d"), "v")
    want = df.withColumn("place", F.rank().over(order))
    got = rank_within(df, ["g", "h"], ["d", "v"], [False, True], "place")
    assert rows(got) == rows(want)


def test_copies_of_one_row_hold_a_third_of_all(spark):
    values = [(0, "hot", 5)] * 100 + [(i, "hot", i) for i in range(100)] + [
        (i, f"g{i % 20}", i) for i in range(100)
    ]
    df = spark.createDataFrame(values, SCHEMA)
    got = rank_within(df, ["g"], ["v"])
    assert Counter(rows(got)) == Counter(brute_force(values))


def test_whole_table_as_one_group_and_a_column_replaced(spark, settings):
    in_parts(spark, settings, 20)
    values = [(i, None, i % 9) for i in range(90)]
    df = spark.createDataFrame(values, SCHEMA)
    ranked = rank_within(df, [], ["v"], name="g")
    assert ranked.columns == ["id", "g", "v"]
    assert rows(ranked) == rows(
        spark.createDataFrame([(i, 1 + 10 * (i % 9), i % 9) for i in range(90)], "a int, b long, c int")
    )


def test_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert rank_within(df, ["g"], ["v"]).collect() == []


def test_large_groups_are_not_sorted_in_one_task(spark, settings):
    in_parts(spark, settings, 8)
    df = spark.range(10_000).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    ranked = rank_within(df, ["g"], ["v"])
    spread = ranked.where("g = 0").select(F.floor(F.col("rank") / 1000)).distinct().count()
    assert spread == 6
    assert ranked.where("rank != 1 + floor(v / 2)").count() == 0


def test_one_stored_table_and_any_column_names(spark, settings, tmp_path):
    in_parts(spark, settings, 7)
    df = spark.createDataFrame(VALUES, SCHEMA)
    odd = df.toDF("_rank", "k0", "a.b").withColumn("part", F.lit(1)).withColumn("row", F.lit("x"))
    names = []

    def noted(frame, label):
        names.append(label)
        return stored(frame, label)

    before, ranking.stored = ranking.stored, noted
    try:
        got = rank_within(odd, ["k0"], ["a.b"], name="_k0")
    finally:
        ranking.stored = before
    assert names == ["ranked"]
    assert got.columns == ["_rank", "k0", "a.b", "part", "row", "_k0"]
    want = rank_within(df, ["g"], ["v"])
    assert rows(got.drop("part", "row")) == rows(want)


@pytest.mark.parametrize("batch", ["1", "2", "7"])
@pytest.mark.parametrize("parts", [2, 9])
def test_groups_over_batches_and_parts(spark, batch, parts, settings):
    """The pass over sorted rows carries group and value from batch to batch."""
    in_parts(spark, settings, parts)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    settings.callbacks.append((spark, "spark.sql.execution.arrow.maxRecordsPerBatch", before))
    nan = float("nan")
    values = [(i, g, v) for i, (g, v) in enumerate(
        [(g, v) for g in (None, 0.0, nan, 2.5) for v in (None, -1.0, nan, nan, 7.0, 7.0, None)] * 3)]
    df = spark.createDataFrame(values, "id int, g double, v double")
    order = Window.partitionBy("g").orderBy("v")
    # As text, since NaNs are not equal.
    assert [*map(str, rows(rank_within(df, ["g"], ["v"])))] == [
        *map(str, rows(df.withColumn("rank", F.rank().over(order).cast("long"))))]


def test_nested_and_binary_keys(spark):
    df = spark.range(200).select(
        "id", F.struct((F.col("id") % 3).alias("a"), F.lit(None).cast("int").alias("b")).alias("g"),
        F.array(F.col("id") % 5).alias("v"), F.encode((F.col("id") % 2).cast("string"), "UTF-8")
        .alias("w"))
    order = Window.partitionBy("g", "w").orderBy("v")
    assert rows(rank_within(df, ["g", "w"], ["v"])) == rows(
        df.withColumn("rank", F.rank().over(order).cast("long")))


def test_rows_are_shuffled_once(spark, monkeypatch):
    """By range, and not again for the ranks; what moves them is a few rows of each part."""
    plans = []

    def keep(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, label)

    monkeypatch.setattr(ranking, "stored", keep)
    df = spark.range(1000).selectExpr("id", "id % 7 as g", "id % 11 as v")
    assert rank_within(df, ["g"], ["v"]).count() == 1000
    assert plans[0].count("Exchange") == 1 and "rangepartitioning" in plans[0]
