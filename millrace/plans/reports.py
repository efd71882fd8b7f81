"""Batch reports put together from the operators."""

from pyspark.sql import DataFrame

from ..operators import enrich_with_title, rated_items, top_rated


def ratings_report(ratings: DataFrame, titles: DataFrame, k: int | None = None,
                   min_count: int = 100, item: str = "item_id", rating: str = "rating",
                   title_key: str = "movie_id") -> DataFrame:
    """Items rated more than ``min_count`` times with their title, best average first."""
    items = rated_items(ratings, item, rating, min_count)
    return top_rated(enrich_with_title(items, titles, item, title_key), k, tie=item)
