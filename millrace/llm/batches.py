"""Helpers the operators share: columns by name, Arrow functions per batch, folds and samples."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """A column by its plain name, whatever characters are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, whatever the case of its letters."""
    taken = {name.lower() for name in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
                schema: str | StructType) -> DataFrame:
    """``fn`` over each Arrow batch; a result of None is no rows.

    Within a batch Python looks for no reference cycles: there are none, and looking through what
    a worker remembers takes long.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                gc.disable()
                try:
                    result = fn(batch)
                finally:
                    gc.enable()
                if result is not None and result.num_rows:
                    yield result

    return df.mapInArrow(run, schema)


def texts_of(array: pa.Array) -> Iterator[str | None]:
    """The texts one by one, so that a batch is not held twice."""
    return (value.as_py() for value in array)


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id, as text, leaves ``fold`` when divided by ``folds``."""
    return F.coalesce(F.crc32(column(id_col).cast("string")) % folds == fold, F.lit(False))


def spread(*columns: Column) -> Column:
    """A number from 0 to 1 that depends on the columns alone, evenly spread."""
    return F.pmod(F.xxhash64(F.lit("spread"), *columns), F.lit(1 << 40)) / float(1 << 40)
