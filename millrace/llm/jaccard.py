"""An exact Jaccard join of documents as sets of word n-grams, by pivots and regions.

With Jaccard distance 1 - J the documents are points of a metric space, and two link if they lie no
farther apart than a radius.  Two that link share several of the first few shingles of both, in any
order of all shingles; here common shingles come last.  A document of which too few of the first
shingles are found anywhere else is alone.  The others with such a shingle form a cell; its pivot is
the one with the smallest hash, and the cells of a pivot together are its region.  So each pair that
links lies in at least one region; documents near a border are copied to several.

A region is first looked at with a fixed part of all shingles, in which two sets differ no more than
in all.  What may still link, over all regions, is joined again by whole sets.  If it is of moderate
size one task does so.  A larger region takes further pivots: documents within the radius of a pivot
link to it and need no comparing with each other; the rest goes into blocks by nearest pivot, and
the triangle inequality limits which blocks can hold a link, as their distances to each pivot must
come within the radius of each other.  Blocks of documents that are connected already are not
compared with each other, so the work that remains is with those that are not.

Nothing is sampled: the order of the shingles is a hint that changes the cost, not the result.
Copies with equal sets are one point.  A shingle is its 64-bit hash and a set its 128-bit hash.

Null texts and texts without words have no shingles and link with nothing; texts with fewer words
than a shingle have one.  Rows with equal ids count as one document; rows without id have no links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from millrace.workspace import stored

from .batches import column, map_batches, texts_of
from .embeddings import lowest
from .graph import components, join_salted

#: Documents, and shingles in all, that a task joins directly; documents of a block.
REGION_DOCS = 1024
REGION_SHINGLES = 1_500_000
BLOCK_DOCS = 768
#: Further pivots of a large region.
PIVOTS = 8
#: Places of the table of common shingles, and from how many sightings on a shingle is common.
PLACES = 1 << 23
COMMON = 4
#: Shingles that a task counts at a time.
COUNTED = 1_000_000
#: One shingle more is looked at for so many that a document has.
SPARE = 4
#: Most ids sent to all executors; beyond it the join is left to the planner.
SENT_IDS = 2_000_000

P = np.uint64(0x9E3779B97F4A7C15)
P_INVERSE = np.uint64(pow(int(P), -1, 1 << 64))
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


@lru_cache(maxsize=1)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64."""
    result = []
    for base in (P, P_INVERSE):
        factors = np.full(size, base, dtype=np.uint64)
        factors[0] = 1
        result.append(np.multiply.accumulate(factors))
    return result[0], result[1]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int) -> np.ndarray:
    """The sorted distinct hashes of the word n-grams; ASCII letters count as lower case."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
    space = IS_SPACE[raw]
    edges = np.flatnonzero(np.diff(space.astype(np.int8), prepend=1, append=1))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    size = 1 << max(16, int(len(raw)).bit_length())
    up, down = powers(size)
    total = np.empty(len(raw) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=total[1:])
    word = mixed((total[ends] - total[starts]) * down[starts]
                 + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    count = max(len(word) - words + 1, 1)
    gram = np.zeros(count, dtype=np.uint64)
    for k in range(min(words, len(word))):
        gram = mixed(gram * P + word[k:k + count] + np.uint64(k + 1))
    return np.unique(gram)


def missing(n: int, num: int, den: int) -> int:
    """How many of ``n`` shingles a document that links may lack."""
    return n - -(-num * n // den)


def spare(n: int) -> int:
    """How many shingles are looked at beyond the first that must be shared.

    Of the first ``missing + 1 + spare`` of two documents that link, at least ``spare + 1`` are
    shared, with the ``spare`` of the one whose last comes earlier in the order.
    """
    return n // SPARE


def describe(texts: DataFrame, words: int, kind: str) -> DataFrame:
    """Size and hash of each document's set, and in rows with a ``key`` how often tasks saw it.

    Every task counts the shingles of all its documents and passes on those it sees twice.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, key_type = [], 0, None

        def counted() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(waiting), return_counts=True)
            key, n = key[n > 1].view(np.int64), n[n > 1].astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(key), key_type), pa.array(n), pa.nulls(len(key), pa.binary()),
                 pa.array(key)], names)

        for batch in batches:
            key_type, sizes, marks = batch.schema.field(0).type, [], []
            for text in texts_of(batch.column(1)):
                own = shingles(text, words)
                sizes.append(len(own))
                marks.append(mark(own) if len(own) else None)
                waiting.append(own)
                size += len(own)
                if size > COUNTED:
                    yield counted()
                    waiting, size = [], 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(marks, pa.binary()),
                 pa.nulls(batch.num_rows, pa.int64())], names)
        if waiting:
            yield counted()

    names = ["id", "n", "mark", "key"]
    return stored(texts.mapInArrow(run, f"id {kind}, n bigint, mark binary, key bigint"),
                  "described")


def common_shingles(described: DataFrame) -> np.ndarray:
    """A level for each place of a fixed table: how common the shingles are that fall there."""
    place = F.col("key").bitwiseAND(F.lit(PLACES - 1)).alias("place")
    levels = described.where("key is not null").groupBy("key").agg(F.sum("n").alias("n")) \
        .where(F.col("n") >= COMMON) \
        .select(place, F.floor(F.log2("n")).cast("int").alias("level")) \
        .groupBy("place").agg(F.max("level").alias("level"))
    # At most one small row for each place of the table, whatever the corpus.
    found = levels.toArrow()
    table = np.zeros(PLACES, dtype=np.uint8)
    table[found["place"].to_numpy()] = found["level"].to_numpy()
    return table


def first_shingles(own: np.ndarray, count: int, level: np.ndarray) -> np.ndarray:
    """The first ``count``: rarer levels first, then by hash."""
    levels = level[own & np.uint64(PLACES - 1)]
    rare = np.flatnonzero(levels == 0)
    if len(rare) >= count:
        return own[rare[:count]]
    return own[np.argsort(levels, kind="stable")[:count]]


def first_of_each(texts: DataFrame, level: np.ndarray, words: int, num: int, den: int,
                  kind: str) -> DataFrame:
    """The first shingles of each document (id, key), and whether they are known to be common."""
    shipped = texts.sparkSession.sparkContext.broadcast(level)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, counts = [np.empty(0, dtype=np.uint64)], []
        for text in texts_of(batch.column(1)):
            own = shingles(text, words)
            look = missing(len(own), num, den) + 1 + spare(len(own))
            keys.append(first_shingles(own, look, shipped.value))
            counts.append(len(keys[-1]))
        key = np.concatenate(keys)
        take = np.repeat(np.arange(batch.num_rows), counts)
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(take)), pa.array(key.view(np.int64)),
             pa.array(shipped.value[key & np.uint64(PLACES - 1)] > 0)], ["id", "key", "common"])

    return map_batches(texts, run, f"id {kind}, key bigint, common boolean")


def mark(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def only_ids(ids: DataFrame) -> DataFrame:
    """``ids``, marked for sending to all executors if there are few enough of them."""
    return F.broadcast(ids) if ids.limit(SENT_IDS + 1).count() <= SENT_IDS else ids


def fetch_sets(texts: DataFrame, points: DataFrame, words: int, kind: str,
               share: float = 1.0) -> DataFrame:
    """The sets of some points (id, mark, region), from their texts (region, id, n, own).

    Of each the lowest ``share`` of all hashes, and the size of the whole.
    """
    below = np.uint64(min(int(share * 2.0 ** 64), 2 ** 64 - 1))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        take, sizes, sets = [], [], []
        for at, (text, expected) in enumerate(zip(texts_of(batch.column(2)),
                                                  batch.column(3).to_pylist())):
            own = shingles(text, words)
            if mark(own) == expected:
                take.append(at)
                sizes.append(len(own))
                part = own if share >= 1 else own[:np.searchsorted(own, below)]
                sets.append(part.view(np.int64))
        rows = pa.array(take, pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(sizes, pa.int64()),
             pa.array(sets, pa.list_(pa.int64()))], ["region", "id", "n", "own"])

    wanted = texts.join(only_ids(points), "id").select("region", "id", "text", "mark")
    return stored(map_batches(wanted, run, f"region {kind}, id {kind}, n bigint, "
                                           "own array<bigint>"), "sets")


class Sets:
    """Sets of one Arrow table as flat arrays."""

    def __init__(self, lists: pa.Array | pa.ChunkedArray):
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.combine_chunks()
        offsets = lists.offsets.to_numpy().astype(np.int64)
        self.values = lists.values.to_numpy()[offsets[0]:offsets[-1]]
        self.offsets = offsets - offsets[0]
        self.sizes = np.diff(self.offsets)

    def overlaps(self, low: int, high: int, cut: int | None = None) -> np.ndarray:
        """Common shingles of rows ``low`` to ``high``: all pairs, or those before x after ``cut``."""
        a, b = self.offsets[low], self.offsets[high]
        values = self.values[a:b]
        row = np.repeat(np.arange(high - low), self.sizes[low:high])
        unique, at, n = np.unique(values, return_inverse=True, return_counts=True)
        place = np.cumsum(n > 1) - 1
        often = n[at] > 1
        row, col = row[often], place[at[often]]
        order = np.argsort(col, kind="stable")
        row, col = row[order], col[order]
        left = high - low if cut is None else cut - low
        first = 0 if cut is None else left
        result = np.zeros((left, high - low - first), dtype=np.float32)
        width = max(256, min(8192, (1 << 22) // max(high - low, 1)))
        for start in range(0, int(place[-1]) + 1 if len(place) else 0, width):
            i, j = np.searchsorted(col, [start, start + width])
            dense = np.zeros((high - low, width), dtype=np.float32)
            dense[row[i:j], col[i:j] - start] = 1
            result += dense[:left] @ dense[first:].T
        return result

    def links(self, low: int, high: int, num: int, den: int,
              cut: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows that link, counted from ``low``."""
        same = self.overlaps(low, high, cut).astype(np.float64)
        left, right = self.sizes[low:low + len(same)], self.sizes[high - same.shape[1]:high]
        near = (num + den) * same >= num * (left[:, None] + right[None, :])
        x, y = np.nonzero(near)
        y = y + (high - low - same.shape[1])
        return x[x < y], y[x < y]


def grouped(fn: Callable[[pa.Table], pa.Table | None]):
    """``fn`` over tables of whole groups; rows come ordered by their first column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            new = new if rest is None else pa.concat_tables([rest, new]).combine_chunks()
            if not new.num_rows:
                continue
            key = new.column(0)
            end = pc.index(pc.equal(key, key[-1]), True).as_py()
            rest = new.slice(end)
            if end:
                yield from made(fn, new.slice(0, end))
        if rest is not None and rest.num_rows:
            yield from made(fn, rest)

    return run


def made(fn, rows: pa.Table) -> Iterator[pa.RecordBatch]:
    result = fn(rows.combine_chunks())
    if result is not None and result.num_rows:
        yield from result.to_batches()


def group_edges(key: pa.ChunkedArray) -> list[int]:
    """Where groups of equal neighbours start, and the end."""
    changes = pc.not_equal(key.slice(1), key.slice(0, len(key) - 1))
    return [0, *(np.flatnonzero(changes.to_numpy()) + 1).tolist(), len(key)]


def possible(regions: DataFrame, num: int, den: int, kind: str) -> DataFrame:
    """Which members of regions (region, id, n, own) may link, going by a part of their sets, as
    pairs that connect them (one, other).

    What two sets do not share of a part of all shingles is not more than of all of them.
    """
    def run(table: pa.Table) -> pa.Table | None:
        sets, n = Sets(table["own"]), table["n"].to_numpy()
        edges, one, other = group_edges(table.column(0)), [], []
        for low, high in zip(edges, edges[1:]):
            size, whole = sets.sizes[low:high], n[low:high]
            apart = size[:, None] + size[None, :] - 2 * sets.overlaps(low, high)
            x, y = np.nonzero((apart * (num + den) <= (whole[:, None] + whole[None, :])
                               * (den - num)) & (den * whole[:, None] >= num * whole[None, :])
                              & (den * whole[None, :] >= num * whole[:, None]))
            star(x, y, high - low, low, one, other)
        return pair_table(table["id"], one, other)

    return regions.select("region", "id", "n", "own").repartition("region") \
        .sortWithinPartitions("region").mapInArrow(grouped(run), f"one {kind}, other {kind}")


def star(x: np.ndarray, y: np.ndarray, size: int, low: int, one: list, other: list) -> None:
    """Add the pairs that connect what ``x`` and ``y`` connect, places counted from ``low``."""
    labels = np.arange(size)
    lowest(labels, x[x != y], y[x != y])
    linked = np.flatnonzero(labels != np.arange(size))
    if len(linked):
        one.append(low + linked)
        other.append(low + labels[linked])


def join_regions(regions: DataFrame, num: int, den: int, kind: str) -> DataFrame:
    """Links inside regions (region, id, own), each joined by one task."""
    def run(table: pa.Table) -> pa.Table | None:
        sets, take, root = Sets(table["own"]), [], []
        edges = group_edges(table.column(0))
        for low, high in zip(edges, edges[1:]):
            star(*sets.links(low, high, num, den), high - low, low, take, root)
        return pair_table(table["id"], take, root)

    return regions.select("region", "id", "own").repartition("region") \
        .sortWithinPartitions("region").mapInArrow(grouped(run), f"one {kind}, other {kind}")


def pair_table(ids: pa.ChunkedArray, one: list, other: list) -> pa.Table | None:
    if not one:
        return None
    return pa.table({"one": ids.take(pa.array(np.concatenate(one))),
                     "other": ids.take(pa.array(np.concatenate(other)))})


def split_region(members: DataFrame, sets: DataFrame, num: int, den: int, kind: str):
    """Links of large regions (region, id) to further pivots, and each document's distances."""
    slot = F.pmod(F.xxhash64("id", F.lit("slot")), F.lit(PIVOTS)).cast("int").alias("slot")
    chosen = members.groupBy("region", slot).agg(
        F.min(F.struct(F.xxhash64("id").alias("rank"), "id"))["id"].alias("pivot"))
    pivots = chosen.join(sets.select(F.col("id").alias("pivot"), "own"), "pivot").groupBy("region").agg(
        F.sort_array(F.collect_list(F.struct("slot", "pivot", "own"))).alias("pivots"))
    dealt = join_salted(members.join(sets.drop("n"), "id"), stored(pivots, "pivots"), ["region"],
                        F.col("id")).select("region", "id", "own", "pivots")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known: dict = {}
        distances, homes, linked = [], [], []
        own = Sets(batch.column(2))
        region, packed = batch.column(0).to_pylist(), batch.column(3)
        for at in range(batch.num_rows):
            if region[at] not in known:
                known[region[at]] = [
                    (p["pivot"], np.array(p["own"], dtype=np.int64)) for p in packed[at].as_py()]
            mine = own.values[own.offsets[at]:own.offsets[at + 1]]
            row, near = [], []
            for pivot, other in known[region[at]]:
                same = len(np.intersect1d(mine, other, assume_unique=True))
                union = len(mine) + len(other) - same
                row.append(1 - same / union)
                if den * same >= num * union:
                    near.append(pivot)
            distances.append(row)
            homes.append(int(np.argmin(row)))
            linked.append(near)
        key = batch.schema.field(1).type
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(distances, pa.list_(pa.float64())),
             pa.array(homes, pa.int32()), pa.array(linked, pa.list_(key))],
            ["region", "id", "distances", "home", "linked"])

    return stored(map_batches(
        dealt, run, f"region {kind}, id {kind}, distances array<double>, home int, "
                    f"linked array<{kind}>"), "distances")


def join_blocks(placed: DataFrame, sets: DataFrame, known: DataFrame, num: int, den: int,
                kind: str) -> DataFrame:
    """Links of large regions that ``known`` links do not imply, by pairs of blocks."""
    labelled = stored(placed.join(known.withColumnRenamed("node", "id"), "id", "left").select(
        "region", "id", "distances", "home", F.coalesce("component", "id").alias("component")),
        "labelled")
    parts = labelled.groupBy("region", "component").count()
    main = parts.groupBy("region").agg(F.max_by("component", F.struct("count", "component"))
                                       .alias("main"), F.count("*").alias("parts"))
    # Regions that are connected already hold no further link.
    open_ = join_salted(labelled, stored(main.where("parts > 1"), "main"), ["region"],
                        F.col("id")).withColumn("inside", F.col("component") == F.col("main"))
    sizes = stored(open_.groupBy("region", "inside", "home").count(), "sizes")
    cell = F.pmod(F.xxhash64("id", F.lit("cell")),
                  F.ceil(F.col("count") / BLOCK_DOCS)).cast("bigint")
    celled = stored(join_salted(open_, sizes, ["region", "inside", "home"], F.col("id")).select(
        "region", "inside", "home", cell.alias("cell"), "id", "distances"), "celled")
    bounds = [f(F.col("distances")[k]).alias(f"{name}{k}") for k in range(PIVOTS)
              for name, f in (("low", F.min), ("high", F.max))]
    # With fewer pivots than places the missing distances are null and bound nothing.
    blocks = stored(celled.withColumn("distances", F.concat(
        "distances", F.array_repeat(F.lit(None).cast("double"), PIVOTS))).groupBy(
            "region", "inside", "home", "cell").agg(*bounds).withColumn(
                "block", F.struct("inside", "home", "cell")), "blocks")
    one, two = blocks.where("not inside").alias("a"), blocks.alias("b")
    radius = (den - num) / den + 1e-9
    close = [F.coalesce((F.col(f"a.low{k}") <= F.col(f"b.high{k}") + radius)
                        & (F.col(f"b.low{k}") <= F.col(f"a.high{k}") + radius), F.lit(True))
             for k in range(PIVOTS)]
    apart = F.col("b.inside") | (F.col("a.block") <= F.col("b.block"))
    condition = (F.col("a.region") == F.col("b.region")) & apart
    for near in close:
        condition = condition & near
    pairs = one.join(two, condition).select(
        F.col("a.region").alias("region"), F.col("a.block").alias("first"),
        F.col("b.block").alias("second")).withColumn(
            "task", F.xxhash64("region", "first", "second"))
    sides = stored(pairs.select("region", "task", F.explode(F.array_distinct(F.array(
        F.struct(F.lit(0).alias("side"), F.col("first").alias("block")),
        F.struct((F.when(F.col("first") == F.col("second"), 0).otherwise(1)).alias("side"),
                 F.col("second").alias("block"))))).alias("s")).select(
                     "region", "task", "s.side", "s.block.*"), "pairs")
    rows = celled.drop("distances").join(sides, ["region", "inside", "home", "cell"]) \
        .join(sets.drop("n"), "id").select("task", "side", "id", "own")

    def run(table: pa.Table) -> pa.Table | None:
        own, side = Sets(table["own"]), table["side"].to_numpy()
        take, root = [], []
        edges = group_edges(table.column(0))
        for low, high in zip(edges, edges[1:]):
            cut = low + int(np.count_nonzero(side[low:high] == 0))
            star(*own.links(low, high, num, den, None if cut == high else cut), high - low, low,
                 take, root)
        return pair_table(table["id"], take, root)

    return rows.repartition("task").sortWithinPartitions("task", "side") \
        .mapInArrow(grouped(run), f"one {kind}, other {kind}")


def jaccard_components(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_shingles`` and ``component_id``.

    Two documents link if ``den`` * intersection >= ``num`` * union of their sets of ``words``-word
    shingles; the component is the smallest id reachable by links.
    """
    texts = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    both = describe(texts, words, kind)
    described = both.where("key is null").drop("key")
    points = stored(described.where("n > 0 and id is not null").groupBy("mark").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.count("*").alias("copies")), "points")
    copied = points.where("copies > 1").select("mark", F.col("id").alias("first"))
    others = stored(join_salted(described, copied, ["mark"], F.col("id"))
                    .where("id <> first").select("id").distinct(), "copies")
    distinct = texts.where("id is not null").join(only_ids(others), "id", "left_anti")
    first = first_of_each(distinct, common_shingles(both), words, num, den, kind)
    links = find_links(distinct, first, points, words, num, den, kind)
    component = components(links, "one", "other").withColumnRenamed("node", "id")
    # What differs from a document without links.
    noted = points.join(component, "id", "left").where("copies > 1 or component is not null") \
        .select("mark", F.coalesce("component", "id").alias("component"))
    judged = join_salted(described.select("id", "n", "mark"), noted, ["mark"], F.col("id"), "left")
    return judged.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                         F.coalesce("component", "id").alias("component_id"))


def find_links(texts: DataFrame, first: DataFrame, points: DataFrame, words: int, num: int,
               den: int, kind: str) -> DataFrame:
    """Links that connect all points of each component (one, other)."""
    # Common shingles are shared, without counting; the others are in few documents each.
    alike = Window.partitionBy("key", F.when(F.col("common"), F.col("id")))
    shared = stored(first.withColumn("n", F.count("*").over(alike))
                    .where("common or n > 1").select("id", "key"), "shared")
    # The smallest partner that a document of n shingles can have needs the least in common.
    partner = f"(({num} * n + {den - 1}) div {den})"
    company = shared.groupBy("id").count().join(
        points.select("id", F.expr(f"{partner} div {SPARE} + 1").alias("least")), "id") \
        .where("count >= least").select("id")
    close = stored(shared.join(company, "id"), "close")
    cells = stored(close.groupBy("key").agg(
        F.min(F.struct(F.xxhash64("id").alias("rank"), "id"))["id"].alias("region"),
        F.count("*").alias("n")).where("n > 1").drop("n"), "cells")
    regions = stored(close.join(cells, "key").select("region", "id").distinct(), "regions")
    marks = points.select("id", "mark")
    docs, shingle_sum = F.count("*").alias("docs"), F.sum("n").alias("shingles")
    large = (F.col("docs") > REGION_DOCS) | (F.col("shingles") > REGION_SHINGLES)
    weights = stored(regions.join(points.select("id", "n"), "id").groupBy("region").agg(
        docs, shingle_sum), "weights")
    small = stored(regions.join(weights.where(~large).select("region"), "region"), "moderate")
    part = fetch_sets(texts, small.select("id").distinct().join(marks, "id").withColumn(
        "region", F.col("id")), words, kind, min(1.0, 2.4 * (den - num) / (den + num)))
    near = possible(small.join(part.drop("region"), "id"), num, den, kind)
    # What may link is one region, so that each whole set is read and sent once; the members of a
    # region too large for one task are taken for such without a look at parts of their sets.
    whole = regions.join(weights.where(large).select("region"), "region")
    together = stored(near.unionByName(whole.select(F.col("id").alias("one"),
                                                    F.col("region").alias("other"))), "together")
    hung = components(together, "one", "other")
    members = stored(hung.select(F.col("component").alias("region"), F.col("node").alias("id"))
                     .unionByName(hung.select(F.col("component").alias("region"),
                                              F.col("component").alias("id")).distinct()), "members")
    sets = fetch_sets(texts, members.join(marks, "id"), words, kind)
    sizes = stored(sets.groupBy("region").agg(docs, shingle_sum), "sizes")
    direct = sets.join(sizes.where(~large).select("region"), "region")
    found = stored(join_regions(direct, num, den, kind), "near")
    big = sizes.where(large).select("region")
    if big.isEmpty():
        return found
    inside = stored(members.join(big, "region"), "inside")
    placed = split_region(inside, sets.drop("region"), num, den, kind)
    to_pivots = placed.select(F.col("id").alias("one"), F.explode("linked").alias("other"))
    known = stored(found.unionByName(to_pivots), "near")
    return known.unionByName(join_blocks(
        placed, sets.drop("region"), components(known, "one", "other"), num, den, kind))


def keep_one(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` but for those linked to a document with a smaller id.

    Of rows with the same id and text one stays.
    """
    found = stored(jaccard_components(docs, words, num, den, id_col, text_col), "classes")
    key = column(id_col)
    others = found.where(key != F.col("component_id")).select(key).distinct()
    kept = docs.join(only_ids(others), id_col, "left_anti")
    twice = stored(found.where(key.isNotNull() & (F.col("n_shingles") > 0)).groupBy(key).count()
                   .where("count > 1").select(key), "twice")
    if twice.isEmpty():
        return kept
    repeated = only_ids(twice)
    return kept.join(repeated, id_col, "left_anti").unionByName(
        kept.join(repeated, id_col, "left_semi").dropDuplicates([id_col, text_col]))
