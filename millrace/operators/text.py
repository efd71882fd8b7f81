"""Lines of text."""

from pyspark.sql import DataFrame, functions as F


def words(df: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per word of ``column``, split at single spaces; repeated spaces give empty words.

    ``keep`` names columns to carry along.  Works on a micro-batch stream as well, but not under a
    continuous trigger, where Spark allows no generator.
    """
    return df.select(*keep, F.explode(F.split(column, " ")).alias("word"))
