"""Counts that a stream holds back until their window is closed, read from its checkpoint."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from ..operators.windows import flatten_window


def open_windows(spark: SparkSession, checkpoint: str, values: list[str],
                 batch: int | None = None, operator: int = 0) -> DataFrame:
    """``window_start, window_end``, the other keys and ``values`` of the windows still open after the
    last batch, or after number ``batch``.

    ``values`` names what the stream counts, in its order: the state itself may have one name for
    several.  The stream may go on meanwhile; its checkpoint is only read.  The state of a batch can
    be read as long as the stream retains it.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    state = reader.load(checkpoint)
    named = StructType([StructField(name, field.dataType) for name, field in zip(
        values, state.schema["value"].dataType.fields, strict=True)])
    rows = state.select("key.*", F.col("value").cast(named).alias("value")).select("*", "value.*") \
        .drop("value")
    return flatten_window(rows)
