"""Near-duplicate vectors by tiles of int8 products with error bounds.

Equal vectors are one vector with a number of copies.  The others are dealt over blocks, and each
pair of blocks is one tile, so that all pairs are compared and none is lost.  In a tile each unit
vector is a scale times whole numbers up to 127 plus a rest whose length is known.  A product of two
vectors then differs from the product of their whole numbers by at most what the two rests can add;
only pairs that could reach the threshold with that are computed again in double precision.  The
products of whole numbers are exact: they stay below 2 ** 24, where single precision has no gaps.

Vectors that are null, zero, or hold null or non-finite numbers link with nothing, nor do vectors
of different lengths with each other.  Rows that share an id count as one vector in the links of
others, and each gets a row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.workspace import stored

from .batches import column
from .graph import components, join_salted

#: Most vectors in a block on average, and fewest blocks.
BLOCK = 4096
LEAST_BLOCKS = 8
#: Rows of a tile that are multiplied at a time.
STRIPE = 512


def unit(vectors: np.ndarray) -> np.ndarray:
    """Double-precision unit vectors; large and small numbers are scaled first."""
    vectors = vectors.astype(np.float64)
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def quantise(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whole numbers (as single precision), scale, length of the rest, length without the rest."""
    scale = np.abs(units).max(axis=1) / 127
    whole = np.rint(units / scale[:, None])
    near = whole * scale[:, None]
    # A little more than the lengths themselves, for the rounding of this very computation.
    rest = np.linalg.norm(units - near, axis=1) * (1 + 1e-12) + 1e-12
    return whole.astype(np.float32), scale, rest, np.linalg.norm(near, axis=1) * (1 + 1e-12)


def tile_links(a: np.ndarray, b: np.ndarray, threshold: float):
    """Pairs (row of a, row of b) with cosine of at least ``threshold``; yields them in stripes."""
    wa, sa, ra, na = quantise(a)
    wb, sb, rb, nb = quantise(b)
    for start in range(0, len(a), STRIPE):
        rows = slice(start, start + STRIPE)
        product = wa[rows] @ wb.T
        # threshold - error, in units of the whole product
        error = na[rows, None] * rb + ra[rows, None] * nb + ra[rows, None] * rb
        least = ((threshold - error - 1e-9) / (sa[rows, None] * sb)).astype(np.float32)
        i, j = np.nonzero(product >= np.nextafter(least, np.float32(-np.inf)))
        i += start
        for part in range(0, len(i), 1 << 18):
            x, y = i[part:part + (1 << 18)], j[part:part + (1 << 18)]
            sure = np.einsum("ij,ij->i", a[x], b[y]) >= threshold
            if sure.any():
                yield x[sure], y[sure]


def lowest(labels: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Join the sets of ``x`` and ``y``; labels point to lower places until they stand still."""
    while True:
        low = np.minimum(labels[x], labels[y])
        if (labels[x] == low).all() and (labels[y] == low).all():
            return
        np.minimum.at(labels, labels[x], low)
        np.minimum.at(labels, labels[y], low)
        while True:
            jumped = labels[labels]
            if (jumped == labels).all():
                break
            labels[:] = jumped


def tile(table: pa.Table, threshold: float) -> pa.Table:
    """For each vector of a tile with links: their number, and one vector of its component."""
    order = np.argsort(table["id"].to_numpy(), kind="stable")
    ids = table["id"].to_numpy()[order]
    copies = table["copies"].to_numpy()[order]
    side = table["block"].to_numpy()[order]
    flat = table["vector"].combine_chunks()
    lengths = flat.value_lengths().to_numpy()[order]
    starts = flat.offsets.to_numpy()[:-1][order]
    values = flat.values.to_numpy()
    first, second = table["first"][0].as_py(), table["second"][0].as_py()
    labels, links = np.arange(len(ids)), np.zeros(len(ids), dtype=np.int64)
    for length in np.unique(lengths):
        a = np.flatnonzero((lengths == length) & (side == first))
        b = np.flatnonzero((lengths == length) & (side == second))
        if not len(a) or not len(b):
            continue
        left = unit(values[starts[a][:, None] + np.arange(length)])
        right = left if first == second else unit(values[starts[b][:, None] + np.arange(length)])
        for i, j in tile_links(left, right, threshold):
            x, y = a[i], b[j]
            if first == second:
                x, y = x[x < y], y[x < y]
            links += np.bincount(x, weights=copies[y], minlength=len(ids)).astype(np.int64)
            links += np.bincount(y, weights=copies[x], minlength=len(ids)).astype(np.int64)
            lowest(labels, x, y)
    some = links > 0
    return pa.table({"id": ids[some], "links": links[some], "root": ids[labels[some]]})


def near_vectors(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id`` and ``kept``.

    Ids may be of any type that has an order.  A row whose id is null links like any other; it names
    no component unless all of it have none, and is kept then only.
    """
    kind = "float" if vectors.schema[vector_col].dataType.elementType.typeName() == "float" \
        else "double"
    rows = vectors.select(column(id_col).alias("id"),
                          column(vector_col).cast(f"array<{kind}>").alias("vector"))
    limit = float("inf")
    usable = F.coalesce(
        F.forall("vector", lambda x: F.coalesce(
            ~F.isnan(x) & (F.abs(x) < limit), F.lit(False)))
        & F.exists("vector", lambda x: x != 0), F.lit(False))
    keys = ["key_1", "key_2"]
    # Adding zero makes both zeros one, so that equal vectors have equal keys.
    plain = F.transform("vector", lambda x: x + F.lit(0).cast(kind))
    keyed = rows.withColumn("usable", usable).withColumn("vector", plain).withColumns({
        "key_1": F.xxhash64("vector"), "key_2": F.xxhash64(F.lit("second"), "vector")})
    # Two 64-bit sums stand for a vector, and a number for both from here on.
    distinct = stored(
        keyed.where("usable").groupBy(*keys).agg(
            F.min("id").alias("least"), F.count("*").alias("copies"),
            F.first("vector").alias("vector"))
        .withColumn("id", F.monotonically_increasing_id()), "vectors")
    blocks = max(LEAST_BLOCKS, math.ceil(distinct.count() / BLOCK))
    own = F.pmod(F.xxhash64("key_1", F.lit("block")), F.lit(blocks)).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
    dealt = distinct.select("id", "copies", "vector", own.alias("block"), others).withColumns({
        "first": F.least("block", "other"), "second": F.greatest("block", "other")}).drop("other")
    found = stored(
        dealt.repartition(blocks * (blocks + 1) // 2, "first", "second")
        .groupBy("first", "second").applyInArrow(
            lambda table: tile(table, threshold), "id bigint, links bigint, root bigint"), "tiles")
    total = found.groupBy("id").agg(F.sum("links").alias("links"))
    component = components(found, "id", "root").withColumnRenamed("node", "id")
    # What differs from a vector without links: copies, links or another component.
    member = distinct.select(*keys, "id", "least", "copies").join(total, "id", "left") \
        .join(component, "id", "left").withColumn("component", F.coalesce("component", "id"))
    member = stored(member.where("copies > 1 or links is not null"), "members")
    smallest = member.groupBy("component").agg(F.min("least").alias("component_id"))
    noted = join_salted(member, smallest, ["component"], F.col("id"), "left").select(
        *keys, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.lit(True).alias("noted"), "component_id")
    judged = join_salted(
        keyed.select("id", *[F.when(F.col("usable"), F.col(k)).alias(k) for k in keys]),
        noted, keys, F.col("id"), "left")
    component_id = F.when(F.col("noted"), F.col("component_id")).otherwise(F.col("id"))
    return judged.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component_id.alias("component_id"), F.col("id").eqNullSafe(component_id).alias("kept"))
