"""Rating-style reports: averages and counts per key, group filter, lookup join, ranking."""

from pyspark.sql import DataFrame, functions as F


def global_average(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """One row with the average of ``column``; NULLs are left out, an empty input gives NULL."""
    return df.select(F.avg(column).alias(name or f"avg({column})"))


def count_by(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """Rows per key.  Counted within each input partition first, so a hot key shuffles as one row
    per partition."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def rated_items(ratings: DataFrame, item: str = "item_id", rating: str = "rating",
                min_count: int = 100) -> DataFrame:
    """``item, cnt, avg`` of the items with more than ``min_count`` non-NULL ratings."""
    return (
        ratings.groupBy(item)
        .agg(F.count(rating).alias("cnt"), F.avg(rating).alias("avg"))
        .where(F.col("cnt") > min_count)
    )


def enrich_with_title(items: DataFrame, titles: DataFrame, item: str = "item_id",
                      title_key: str = "movie_id") -> DataFrame:
    """Inner join to a dimension; both keys are kept, items or titles without partner drop out.

    No hint is given: Spark broadcasts a side only below its size threshold and otherwise
    sort-merges on the key by which ``rated_items`` has left its result partitioned.
    """
    return items.join(titles, items[item] == titles[title_key], "inner")


def top_rated(df: DataFrame, k: int | None = None, by: str = "avg",
              tie: str = "item_id") -> DataFrame:
    """Highest ``by`` first; with ``k`` only the first k rows, found without a full sort.

    ``tie`` makes the order total.  It also spreads a value that many rows share over several
    range partitions when everything is sorted.
    """
    ranked = df.orderBy(F.desc(by), F.asc(tie))
    return ranked if k is None else ranked.limit(k)
