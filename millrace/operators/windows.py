"""Counts per tumbling event-time window and key, the same for batch and stream.

On a batch frame the watermark has no effect.  On a stream in append mode a window is emitted once,
when the watermark passes its end; later rows for it are dropped.  Rows are counted within each
input partition before the shuffle, so a hot key costs one row per partition and window.
"""

from pyspark.sql import DataFrame, functions as F


def windowed_counts(events: DataFrame, *keys: str, time_column: str = "event_time",
                    width: str = "1 minute", delay: str = "2 minutes",
                    name: str = "count") -> DataFrame:
    """``window, *keys, count``; rows without event time are not counted."""
    return (
        events.withWatermark(time_column, delay)
        .groupBy(F.window(time_column, width), *keys)
        .agg(F.count(F.lit(1)).alias(name))
    )


def windowed_edit_counts(events: DataFrame, key: str = "page_title",
                         time_column: str = "event_time", minor: str = "minor",
                         width: str = "2 minutes", delay: str = "10 minutes") -> DataFrame:
    """``window_start, window_end, key, edit_count, minor_edits, major_edits``.

    A row whose ``minor`` is NULL is neither minor nor major.  Filter the events before: only rows
    that are kept may advance the watermark.
    """
    counts = (
        events.withWatermark(time_column, delay)
        .groupBy(F.window(time_column, width), key)
        .agg(
            F.count(F.lit(1)).alias("edit_count"),
            F.count(F.when(F.col(minor), 1)).alias("minor_edits"),
            F.count(F.when(~F.col(minor), 1)).alias("major_edits"),
        )
    )
    return flatten_window(counts)


def flatten_window(df: DataFrame, column: str = "window") -> DataFrame:
    """Replace a window struct by ``<column>_start`` and ``<column>_end``, placed first."""
    rest = [name for name in df.columns if name != column]
    return df.select(
        F.col(f"{column}.start").alias(f"{column}_start"),
        F.col(f"{column}.end").alias(f"{column}_end"),
        *rest,
    )
