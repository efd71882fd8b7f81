"""Nested fields."""

from pyspark.sql import DataFrame, functions as F


def lift_nested_field(df: DataFrame, path: str, name: str | None = None,
                      keep_null: bool = False) -> DataFrame:
    """Add the nested field ``a.b`` as top-level column ``a_b`` and keep the rows that have it.

    A field missing in a row, a NULL struct and a NULL field all count as not having it.  The input
    schema must name the field: read the JSON with a schema rather than an inferred one where no
    record may carry it.
    """
    lifted = name or path.replace(".", "_")
    out = df.withColumn(lifted, F.col(path))
    return out if keep_null else out.where(F.col(lifted).isNotNull())
