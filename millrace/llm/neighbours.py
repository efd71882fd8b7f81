"""Nearest vectors by a permutation index: pivots in order, inverted files, footrule distance.

A vector is represented by its nearest pivots in their order.  Two vectors that are near see the
pivots in much the same order, so their footrule distance (how far each pivot is moved from one
order to the other, one that is missing stands behind the last) is small.  The index deals the
vectors over blocks; in a block each pivot has an inverted file with the vectors that have it and
how early.  A query reads the files of its own pivots, which gives the footrule distance to every
vector of the block, and those up to a radius are ranked again by their true distance.

The radius is not guessed: for up to ``CALIBRATION`` queries, chosen by a hash, the true neighbours
among all rows are found, and the radius takes in the share ``RECALL`` of them.  There is no cap on
candidates or files.  A query for which fewer than ``nearest`` vectors are found is compared with all
rows instead, so every query gets as many as there are.

Ids are whole numbers; rows whose id is null or no number, and vectors that are null, empty, zero or
hold null or non-finite numbers, take no part.  Repeated rows are one row.  An id that comes with
several vectors asks with each and is found at its nearest one.  A shorter vector counts as filled
up with zeros.  Without queries there are no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.workspace import stored

from .batches import column, map_batches

#: Pivots, at most, and how many of them represent a vector.
PIVOTS, PREFIX = 256, 64
#: Queries that the radius is fitted on, at most, and the share of their neighbours it takes in.
CALIBRATION, RECALL = 64, 0.98
#: Most vectors of a block and queries of a tile on average, and fewest blocks.
BLOCK, QUERY_BLOCK, LEAST_BLOCKS = 16_384, 4_096, 8


def matrix(lists: pa.ListArray, width: int = 0) -> np.ndarray:
    """Rows of numbers in double precision, filled up with zeros to the longest (or ``width``)."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    starts = lists.offsets.to_numpy()[:-1]
    values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
    width = max(width, int(sizes.max(initial=0)))
    if len(sizes) and (sizes == width).all():
        return values[starts[0]:starts[0] + len(sizes) * width].reshape(len(sizes), width)
    rows = np.zeros((len(sizes), width))
    for row, start, size in zip(rows, starts, sizes):
        row[:size] = values[start:start + size]
    return rows


def orders(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The numbers of each vector's nearest pivots, nearest first."""
    width = max(vectors.shape[1], pivots.shape[1])
    vectors, pivots = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (vectors, pivots))
    # Scaled, so that no square is too large; this does not change the order.
    scale = max(np.abs(vectors).max(initial=0), np.abs(pivots).max(initial=0), 1e-300)
    vectors, pivots = vectors / scale, pivots / scale
    far = (pivots ** 2).sum(axis=1) - 2 * vectors @ pivots.T
    return np.argsort(far, axis=1, kind="stable")[:, :PREFIX].astype(np.uint8)


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision."""
    with np.errstate(over="ignore"):
        far = np.sqrt(((vectors - query) ** 2).sum(axis=1))
    if not np.isfinite(far).all():
        # Too large to square: hypot scales.
        far = np.array([math.hypot(*row) for row in (vectors - query).tolist()])
    return far


@dataclass
class InvertedFiles:
    """For each pivot the vectors of a block that have it, and how many places before the end."""

    members: list[np.ndarray]
    early: list[np.ndarray]
    size: int
    prefix: int

    @staticmethod
    def of(permutations: np.ndarray) -> InvertedFiles:
        size, prefix = permutations.shape
        flat = permutations.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        bounds = np.searchsorted(flat[by_pivot], np.arange(PIVOTS + 1))
        member = (by_pivot // max(prefix, 1)).astype(np.int32)
        early = (prefix - by_pivot % max(prefix, 1)).astype(np.int32)
        cut = list(zip(bounds[:-1], bounds[1:]))
        return InvertedFiles([member[a:b] for a, b in cut], [early[a:b] for a, b in cut], size,
                             prefix)

    def footrule(self, permutation: np.ndarray) -> np.ndarray:
        """The footrule distance of a query to each vector, from the files of its pivots.

        All places of both orders together are ``prefix * (prefix + 1)``; a shared pivot takes away
        twice the earliness of the side where it comes later.
        """
        shared = np.zeros(self.size, dtype=np.int32)
        for place, pivot in enumerate(permutation.tolist()):
            shared[self.members[pivot]] += np.minimum(self.early[pivot], self.prefix - place)
        return self.prefix * (self.prefix + 1) - 2 * shared


def search(table: pa.Table, radius: int | None, nearest: int) -> pa.Table:
    """For each query of a tile its nearest vectors within ``radius`` (None: all)."""
    table = table.combine_chunks()
    asks = table["asks"].to_numpy(zero_copy_only=False).astype(bool)
    ids = table["id"].to_numpy()
    every = matrix(table["vector"].combine_chunks())
    codes = np.frombuffer(b"".join(table["pivots"].to_pylist()), np.uint8).reshape(len(ids), -1)
    rows, queries = np.flatnonzero(~asks), np.flatnonzero(asks)
    vectors, row_ids = every[rows], ids[rows]
    files = InvertedFiles.of(codes[rows])
    out: list[tuple] = []
    keys = table["key"].to_pylist()
    for q in queries:
        foot = files.footrule(codes[q])
        fits = row_ids != ids[q]
        if radius is not None:
            fits &= foot <= radius
        some = np.flatnonzero(fits)
        far = distances(vectors[some], every[q])
        if len(some) > 8 * nearest:
            # An id may come several times, so more than ``nearest`` are sorted.
            limit = np.partition(far, 4 * nearest)[4 * nearest]
            few = far <= limit
            if len(np.unique(row_ids[some[few]])) > nearest:
                some, far = some[few], far[few]
        order = np.lexsort((row_ids[some], far))
        taken: set[int] = set()
        for k in order:
            found = int(row_ids[some[k]])
            if found not in taken:
                taken.add(found)
                out.append((keys[q], int(ids[q]), found, float(far[k]), int(foot[some[k]])))
                if len(taken) == nearest:
                    break
    names = ["key", "query", "id", "far", "foot"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32()]
    columns = list(zip(*out)) if out else [()] * len(names)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names)


@dataclass
class PermutationIndex:
    """``rows``: id, key (a hash of the vector), vector, pivots (its order), block; stored."""

    rows: DataFrame
    blocks: int
    radius: int = 0

    def ask(self, queries: DataFrame, radius: int | None, nearest: int) -> DataFrame:
        """``key, query, id, far, foot`` of the nearest rows of each query, which is a row of the
        index.

        Each tile holds one block of the rows and one of the queries, both of bounded size and dealt
        by hash, so no key makes a tile large.
        """
        parts = max(1, math.ceil(queries.count() / QUERY_BLOCK))
        columns = ["id", "key", "vector", "pivots"]

        def numbers(n: int) -> Column:
            return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

        rows = self.rows.select(*columns, F.lit(False).alias("asks"), "block",
                                numbers(parts).alias("part"))
        asking = queries.select(
            *columns, F.lit(True).alias("asks"), numbers(self.blocks).alias("block"),
            F.pmod(F.xxhash64("id", "key", F.lit("part")), F.lit(parts)).cast("int").alias("part"))
        found = rows.unionByName(asking) \
            .repartition(self.blocks * parts, "block", "part").groupBy("block", "part") \
            .applyInArrow(lambda tile: search(tile, radius, nearest),
                          "key bigint, query bigint, id bigint, far double, foot int")
        # An id with several vectors in several blocks counts with its nearest.
        single = found.groupBy("key", "query", "id").agg(
            F.min(F.struct("far", "foot")).alias("at")).select("key", "query", "id", "at.*")
        place = Window.partitionBy("key", "query").orderBy("far", "id")
        return single.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= nearest)


def usable_rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, key, vector`` of the rows that take part, each once."""
    element = vectors.schema[vector_col].dataType.elementType.typeName()
    kind = "float" if element == "float" else "double"
    limit = float("inf")
    rows = vectors.select(column(id_col).try_cast("bigint").alias("id"),
                          column(vector_col).cast(f"array<{kind}>").alias("vector"))
    whole = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < limit), F.lit(False)))
    fits = F.col("id").isNotNull() & F.coalesce(
        whole & F.exists("vector", lambda x: x != 0), F.lit(False))
    return rows.where(fits).withColumn("key", F.xxhash64("vector")) \
        .groupBy("id", "key").agg(F.first("vector").alias("vector"))


def choose_pivots(rows: DataFrame, count: int) -> np.ndarray:
    """Up to ``count`` different vectors, chosen by a hash; that many at most reach the driver."""
    chosen = [r.key for r in rows.select("key").distinct()
              .orderBy(F.xxhash64("key", F.lit("pivot")), "key").limit(count).collect()]
    found = rows.where(F.col("key").isin(chosen)).groupBy("key") \
        .agg(F.min("vector").alias("vector")).orderBy("key").select("vector").toArrow()
    lists = found["vector"].combine_chunks()
    return matrix(lists) if len(lists) else np.zeros((0, 1))


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                pivots: int = PIVOTS) -> PermutationIndex:
    """Index every row that takes part.  ``pivots`` may be up to 256."""
    rows = stored(usable_rows(vectors, id_col, vector_col), "vectors")
    chosen = choose_pivots(rows, min(pivots, PIVOTS))
    n = rows.count()
    blocks = max(LEAST_BLOCKS, math.ceil(n / BLOCK))

    def code(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = orders(matrix(batch.column(2)), chosen)
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([row.tobytes() for row in own], pa.binary())],
            [*batch.schema.names, "pivots"])

    kind = rows.schema["vector"].dataType.simpleString()
    coded = map_batches(rows.select("id", "key", "vector"), code,
                        f"id bigint, key bigint, vector {kind}, pivots binary")
    block = F.pmod(F.xxhash64("id", "key", F.lit("block")), F.lit(blocks)).cast("int")
    return PermutationIndex(stored(coded.withColumn("block", block), "permutations"), blocks)


def fit_radius(index: PermutationIndex, queries: DataFrame, nearest: int,
               recall: float = RECALL) -> None:
    """Set the radius to the footrule distance within which the share ``recall`` of the true
    neighbours of some queries lies; those are found by comparing with all rows."""
    some = stored(queries.orderBy(F.xxhash64("id", "key", F.lit("fit")), "id", "key")
                  .limit(CALIBRATION), "calibration")
    # At most CALIBRATION * nearest numbers.
    foot = sorted(r.foot for r in index.ask(some, None, nearest).select("foot").collect())
    index.radius = foot[max(math.ceil(recall * len(foot)) - 1, 0)] if foot else 0


def nearest_vectors(vectors: DataFrame, is_query: Column | None = None, nearest: int = 10,
                    id_col: str = "vec_id", vector_col: str = "embedding",
                    recall: float = RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``nearest`` rows found for each query, by Euclidean
    distance and then id.

    ``is_query`` is a condition on the column ``id``; by default ids divisible by 100 ask.
    """
    index = build_index(vectors, id_col, vector_col)
    asks = F.col("id") % 100 == 0 if is_query is None else is_query
    queries = index.rows.where(asks)
    fit_radius(index, queries, nearest, recall)
    found = stored(index.ask(queries, index.radius, nearest), "found")
    # Queries without enough neighbours within the radius are compared with all rows.
    full = found.where(F.col("rank") == nearest).select(F.col("query").alias("id"), "key")
    rest = stored(queries.join(full, ["id", "key"], "left_anti"), "rest")
    result = found.join(full.withColumnRenamed("id", "query"), ["query", "key"], "left_semi")
    if not rest.isEmpty():
        result = result.unionByName(index.ask(rest, None, nearest))
    return result.select(
        F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("vec_id"), F.col("far").alias("score"))
