"""Rank of each row within its group, on one path for groups of any size."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..workspace import stored


def rank_within(df: DataFrame, partition_by: list[str], order_by: list[str],
                ascending: list[bool] | None = None, name: str = "rank") -> DataFrame:
    """Add ``rank() over (partition by .. order by ..)`` as ``name``, a 64-bit count.

    A window function sorts each group in one task.  Here the rows are range-partitioned by group
    and order, so that a large group is many parts and a part has many small groups.  Each part is
    sorted where it lies and its rows get their ranks in one pass over the sorted batches, which
    carries the last group and value from batch to batch; there is no second shuffle.  A group that
    lies in several parts then gets its ranks moved by the rows before.  Rows with equal order values
    may be split between parts as long as they differ in some column.  Columns may have any names;
    ``name`` replaces a column.
    """
    ascending = ascending or [True] * len(order_by)
    keys = [f"k{i}" for i in range(len(partition_by))] or ["k0"]
    values = [f"o{i}" for i in range(len(order_by))]
    order = [F.asc(v) if up else F.desc(v) for v, up in zip(values, ascending, strict=True)]
    # User columns stay inside a struct, away from the names used here.
    rows = df.select(
        F.struct(*[_column(c) for c in df.columns]).alias("row"),
        *([_column(c).alias(k) for c, k in zip(partition_by, keys)]
          or [F.lit(0).alias("k0")]),
        *[_column(c).alias(v) for c, v in zip(order_by, values)],
        F.xxhash64(*[_column(f.name) for f in df.schema if "map<" not in f.dataType.simpleString()])
        .alias("tie"),
    )
    in_order = rows.repartitionByRange(*keys, *order, "tie") \
        .sortWithinPartitions(*keys, *order).drop("tie")
    schema = StructType(in_order.schema.fields + [
        StructField("part", IntegerType()), StructField("rank", LongType()),
        StructField("rows", LongType()), StructField("edge", IntegerType())])
    ranked = stored(in_order.mapInArrow(
        lambda batches: _ranked(batches, len(keys), len(values)), schema), "ranked")
    moves = _moves(ranked, keys, values)
    same = F.col("part") == F.col("at_part")
    for key in keys:
        same &= F.col(key).eqNullSafe(F.col(f"at_{key}"))
    # A part holds one contiguous range, so at most two of its groups lie in other parts too: the
    # number of moves is bounded by the number of parts.
    placed = ranked.join(F.broadcast(moves), same, "left").withColumn("rank", F.coalesce(
        F.when(F.col("rank") == 1, F.col("first_rank")).otherwise(F.col("before") + F.col("rank")),
        F.col("rank")))
    kept = [F.col("row").getField(c).alias(c) if c != name else F.col("rank").alias(name)
            for c in df.columns]
    return placed.select(*kept, *([] if name in df.columns else [F.col("rank").alias(name)]))


def _column(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


# Marks of the rows from which the groups that go over the border of a part are told.
FIRST_ROW, END_OF_FIRST_GROUP, LAST_ROW = 1, 2, 4


def _changes(before: pa.Array | None, column: pa.Array) -> np.ndarray:
    """Whether each value differs from the one before it; NULLs are equal, and so are NaNs."""
    if before is not None:
        column = pa.concat_arrays([before, column])
    left, right = column.slice(0, len(column) - 1), column.slice(1)
    if pa.types.is_nested(column.type):
        differs = np.array([repr(x) != repr(y) for x, y in zip(left.to_pylist(), right.to_pylist())],
                           dtype=bool)
    else:
        unequal = pc.not_equal(left, right)
        if pa.types.is_floating(column.type):
            unequal = pc.and_(unequal, pc.invert(pc.and_(pc.is_nan(left), pc.is_nan(right))))
        # Where a side is NULL the two differ unless both are.
        one_null = pc.xor(pc.is_null(left), pc.is_null(right))
        differs = pc.if_else(pc.is_null(unequal), one_null, unequal).to_numpy(zero_copy_only=False)
    return differs if before is not None else np.concatenate([[True], differs])


def _ranked(batches: Iterator[pa.RecordBatch], n_keys: int,
            n_values: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows with their ``part``, the ``rank`` and number of ``rows`` of their group so far in
    it, and the marks of rows at its ``edge``.

    What goes from batch to batch is the last row's group, value, rank and number.
    """
    part = TaskContext.get().partitionId()
    last: list[pa.Array] | None = None
    rows_so_far, rank_so_far, in_first_group = 0, 0, True
    held: tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray] | None = None

    def out(batch, rank, rows, edge) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(rank), part, np.int32)), pa.array(rank),
             pa.array(rows), pa.array(edge)],
            [*batch.schema.names, "part", "rank", "rows", "edge"])

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = batch.columns[1:1 + n_keys + n_values]
        changes = [_changes(before, column) for before, column in zip(
            last or [None] * len(columns), columns)]
        new_group = np.logical_or.reduce(changes[:n_keys])
        new_value = np.logical_or.reduce(changes)
        at = np.arange(batch.num_rows)
        start = np.maximum.accumulate(np.where(new_group, at, -1))
        rows = np.where(start < 0, rows_so_far + at + 1, at - start + 1)
        value_start = np.maximum.accumulate(np.where(new_value, at, -1))
        rank = np.where(value_start < 0, rank_so_far, rows[value_start])
        edge = np.zeros(batch.num_rows, dtype=np.int32)
        if last is None:
            edge[0] |= FIRST_ROW
            new_group[0] = False
        if in_first_group and new_group.any():
            second = int(new_group.argmax())
            (edge if second else held[3])[second - 1] |= END_OF_FIRST_GROUP
            in_first_group = False
        if held is not None:
            yield out(*held)
        held = batch, rank, rows, edge
        last = [column.slice(len(column) - 1) for column in columns]
        rows_so_far, rank_so_far = int(rows[-1]), int(rank[-1])
    if held is not None:
        held[3][-1] |= LAST_ROW | (END_OF_FIRST_GROUP if in_first_group else 0)
        yield out(*held)


def _moves(ranked: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """For each part of a group in several parts: the rows of the group in parts before, and the
    rank of its first order value, which may go back to an earlier part.

    Only the first and the last group of a part can lie in other parts too, so at most three rows of
    each part are looked at; one task takes them all.
    """
    parts = Window.partitionBy(*keys).orderBy("part")
    value = F.struct(*values)
    totals = ranked.where("edge > 0").drop("row").repartition(1).groupBy(*keys, "part").agg(
        F.max("rows").alias("rows"), F.max("rank").alias("last"),
        F.min_by(value, "rows").alias("low"), F.max_by(value, "rows").alias("high"),
    ).withColumns({
        "n": F.count("*").over(Window.partitionBy(*keys)),
        "before": F.coalesce(F.sum("rows").over(
            parts.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "continued": F.coalesce(F.lag("high").over(parts).eqNullSafe(F.col("low"))
                                & F.lag("rows").over(parts).isNotNull(), F.lit(False)),
    }).where("n > 1")
    # The rank of the last value, where it starts in this very part.
    started = F.when(F.col("last") > 1, F.col("before") + F.col("last")).when(
        ~F.col("continued"), F.col("before") + 1)
    earlier = F.last("started", ignorenulls=True).over(
        parts.rowsBetween(Window.unboundedPreceding, -1))
    return totals.withColumn("started", started).select(
        F.col("part").alias("at_part"), *[F.col(k).alias(f"at_{k}") for k in keys], "before",
        F.when(F.col("continued"), earlier).otherwise(F.col("before") + 1).alias("first_rank"))
