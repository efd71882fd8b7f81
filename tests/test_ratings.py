from conftest import rows

from millrace.operators import count_by, enrich_with_title, global_average, rated_items, top_rated
from millrace.plans import ratings_report
from millrace.schemas import MOVIES, RATINGS


def ratings(spark, *groups):
    """Rows from (item, ratings) pairs."""
    return spark.createDataFrame(
        [(user, item, value, 0) for item, values in groups for user, value in enumerate(values)],
        RATINGS,
    )


def movies(spark, *titles):
    return spark.createDataFrame(titles, MOVIES)


def test_threshold_is_strict_and_counts_ratings_only(spark):
    df = ratings(spark, (1, [4.0, 5.0]), (2, [1.0, 2.0, 3.0]), (3, [1.0, 5.0, None]))
    assert rows(rated_items(df, min_count=2)) == [(2, 3, 2.0)]
    assert rows(rated_items(df, min_count=1)) == [(1, 2, 4.5), (2, 3, 2.0), (3, 2, 3.0)]


def test_join_keeps_both_keys_and_drops_items_without_partner(spark):
    items = rated_items(ratings(spark, (1, [4.0]), (2, [3.0]), (None, [5.0])), min_count=0)
    joined = enrich_with_title(items, movies(spark, (1, "One"), (3, "Three"), (None, "None")))
    assert joined.columns == ["item_id", "cnt", "avg", "movie_id", "movie_title"]
    assert rows(joined) == [(1, 1, 4.0, 1, "One")]


def test_equal_averages_are_ordered_by_item(spark):
    df = ratings(spark, (3, [4.0]), (1, [4.0]), (2, [5.0]), (4, [1.0]))
    ranked = top_rated(rated_items(df, min_count=0))
    assert [row.item_id for row in ranked.collect()] == [2, 1, 3, 4]
    assert [row.item_id for row in top_rated(rated_items(df, min_count=0), 2).collect()] == [2, 1]


def test_averages_and_counts(spark):
    df = ratings(spark, (1, [4.0, None]), (2, [3.0]))
    assert global_average(df, "rating").collect() == [(3.5,)]
    assert global_average(df.where("false"), "rating", "mean").collect() == [(None,)]
    assert rows(count_by(df, "item_id")) == [(1, 2), (2, 1)]


def test_report_reads_two_columns_and_sorts_no_more_than_it_shows(spark, plan, tmp_path):
    path = str(tmp_path / "ratings")
    ratings(spark, (1, [4.0, 2.0])).write.parquet(path)
    text = plan(ratings_report(spark.read.parquet(path), movies(spark, (1, "One")), 10, 1))
    assert "TakeOrderedAndProject(limit=10" in text
    assert "ReadSchema: struct<item_id:int,rating:double>" in text
    assert "partial_count" in text and "PushedFilters: [IsNotNull(item_id)]" in text


def test_large_dimension_joins_on_the_partitioning_of_the_aggregate(spark, plan):
    df = rated_items(ratings(spark, (1, [4.0, 2.0])), min_count=1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(enrich_with_title(df, movies(spark, (1, "One"))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text
    assert text.count("Exchange hashpartitioning(item_id") == 1
    assert text.count("Exchange") == 2
