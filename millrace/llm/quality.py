"""Quality rules: text statistics, fixed rules, and an isolation forest over the statistics.

``text_statistics`` gives the rule numbers of one text.  The forest isolates rows by random splits;
a row that random splits part from the rest early is an anomaly.  It is grown on documents that are
labelled as good, so that the isolation depth says how unlike good text a document is, and the
verdict's threshold is the depth that divides labelled good and bad rows best.

Each tree draws its splits from ``TREE_ROWS`` of all good rows, as isolation forests do; how full its
leaves are is counted over all good rows, and the threshold is placed among all labelled rows.

Null and empty texts have no words and fail the base rule.  Repeated rows, and rows that share an
id, are judged each by their own text.  Without labels of both kinds only the base rule decides.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..workspace import stored
from .batches import column, map_batches, spread, texts_of, unused

# ASCII white space that parts words, the symbols the rule counts, capitals.
SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: A smaller share of repeated lines or words says nothing against a text.
TOLERATED = 0.35
TREES = 100
TREE_ROWS = 256
#: Anomalies are put in order within so many equal parts of 0 to 1.
PARTS = 4096

WIDTH = 9
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_statistics(text: str | None) -> tuple[int, ...]:
    """The five base numbers, then capitals, exclamation marks, distinct words, lines."""
    if not text:
        return (0,) * WIDTH
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    lines, seen, repeated = raw.split(b"\n"), set(), 0
    for line in lines:
        if line in seen:
            repeated += bool(line.strip())
        else:
            seen.add(line)

    def share(chars: bytes) -> int:
        return len(raw) - len(raw.translate(None, chars))

    return (
        n, len(text) - share(SPACE), share(SYMBOLS), repeated, repeated_words(words),
        share(CAPITALS), raw.count(b"!"), len(set(words)), len(lines),
    )


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts, covered, end = Counter(windows), 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEATED_PERCENT * n_words


def features(stats: np.ndarray) -> np.ndarray:
    """Ratios that do not depend on a text's length, one row for each row of statistics."""
    n, chars, symbols, dup, repeat, capitals, marks, distinct, lines = stats.T.astype(float)
    words, letters = np.maximum(n, 1), np.maximum(chars, 1)
    return np.column_stack([
        chars / words, symbols / words, np.maximum(dup / np.maximum(lines, 1), TOLERATED),
        np.maximum(repeat / words, TOLERATED), np.maximum(capitals / letters, 0.1), marks / words,
        distinct / words ** 0.9, np.log1p(words / np.maximum(lines, 1)),
    ])


@dataclass
class Forest:
    """Trees as arrays: for each node the feature, cut, left child (right is the next), depth."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    depth: np.ndarray
    rows: int

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / expected path); near 1 for rows that are isolated at once."""
        total = np.zeros(len(x))
        for depth, at in zip(self.depth, self.leaves(x)):
            total += depth[at]
        return 2.0 ** (-total / len(self.feature) / expected_path(self.rows))

    def leaves(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """The leaf of each row, tree by tree."""
        for feature, cut, left in zip(self.feature, self.cut, self.left):
            at = np.zeros(len(x), dtype=np.int32)
            while True:
                inner = np.flatnonzero(left[at] > 0)
                if not len(inner):
                    break
                node = at[inner]
                at[inner] = left[node] + (x[inner, feature[node]] >= cut[node])
            yield at

    def refilled(self, counts: np.ndarray) -> Forest:
        """The same splits with leaves that hold so many rows each; all trees hold the same rows."""
        share = np.round(counts * (self.rows / counts.sum(axis=1, keepdims=True)))
        level = np.zeros(self.left.shape)
        for tree, left in enumerate(self.left):
            for node in np.flatnonzero(left):
                level[tree, left[node]:left[node] + 2] = level[tree, node] + 1
        paths = np.array([expected_path(n) for n in range(self.rows + 1)])
        return Forest(self.feature, self.cut, self.left, level + paths[share.astype(int)], self.rows)


def expected_path(n: float) -> float:
    """Mean depth at which an unsuccessful search in a random tree of ``n`` rows ends."""
    return 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else float(n == 2)


def grow(x: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 7) -> Forest:
    """An isolation forest over the rows of ``x``; the order of the rows does not matter."""
    x = x[np.lexsort(x.T)]
    rng = np.random.default_rng(seed)
    rows = min(rows, len(x))
    return grow_trees([x[rng.choice(len(x), rows, replace=False)] for _ in range(trees)], seed)


def grow_trees(drawn: list[np.ndarray], seed: int = 7) -> Forest:
    """A tree over each of the draws, which are of one size."""
    rng = np.random.default_rng(seed)
    rows, trees = len(drawn[0]), len(drawn)
    limit = int(np.ceil(np.log2(max(rows, 2))))
    size = 2 ** (limit + 1) + 1
    forest = Forest(*(np.zeros((trees, size), dtype=t) for t in (np.int32, float, np.int32, float)),
                    rows=max(rows, 2))
    for tree, x in enumerate(drawn):
        free, waiting = 1, [(0, x, 0)]
        while waiting:
            node, part, depth = waiting.pop()
            low, high = part.min(axis=0), part.max(axis=0)
            usable = np.flatnonzero(high > low)
            if depth == limit or not len(usable):
                forest.depth[tree, node] = depth + expected_path(len(part))
                continue
            f = rng.choice(usable)
            # Cuts may lie a little outside the rows seen, so that what lies far outside parts off.
            margin = (high[f] - low[f]) * 0.5
            cut = rng.uniform(low[f] - margin, high[f] + margin)
            below = part[:, f] < cut
            forest.feature[tree, node], forest.cut[tree, node] = f, cut
            forest.left[tree, node] = free
            for child, rest in ((free, part[below]), (free + 1, part[~below])):
                if len(rest):
                    waiting.append((child, rest, depth + 1))
                else:
                    forest.depth[tree, child] = depth + 1
            free += 2
    return forest


@dataclass
class QualityModel:
    """A forest, or None where nothing could be learned, and the largest anomaly that passes."""

    forest: Forest | None = None
    threshold: float = 1.0

    def anomaly(self, stats: np.ndarray) -> np.ndarray:
        if self.forest is None or not len(stats):
            return np.zeros(len(stats))
        return self.forest.anomaly(features(stats))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_id: str = "doc_id", label_col: str = "quality") -> QualityModel:
    """Learn from all labelled documents.

    Rows without label, id or document are left out; an id that is labelled twice counts twice.
    """
    usable = labels.select(column(label_id).alias("id"),
                           (column(label_col) > 0).alias("good")).dropna()
    rows = stored(statistics(docs, id_col, text_col).join(usable, "id").select(
        F.xxhash64("id", "stats").alias("key"), "good", "stats"), "statistics")
    size = {r.good: r["count"] for r in rows.groupBy("good").count().collect()}
    if size.get(True, 0) < 2 or not size.get(False):
        return QualityModel()
    good = rows.where("good")
    forest = grow_trees(draws(good, size[True]))
    forest = forest.refilled(leaf_counts(good, forest))
    return QualityModel(forest, calibrate(rows, forest, size[True], size[False]))


def statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id and statistics of the documents that pass the base rule.

    The numbers are far smaller than the texts, so texts are measured before they meet their labels.
    """
    texts = docs.select(column(id_col).alias("id"), column(text_col).alias("text")).where(
        "id is not null")

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        stats = [text_statistics(t) for t in texts_of(batch.column(1))]
        judged = [not base_failed(s[0], s[4]) for s in stats]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(stats, pa.list_(pa.int64()))], ["id", "stats"]).filter(
                pa.array(judged))

    kind = texts.schema["id"].dataType.simpleString()
    return map_batches(texts, measure, f"id {kind}, stats array<bigint>")


def numbers(array: pa.Array) -> np.ndarray:
    """A column of statistics as a matrix."""
    return array.flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)


def draws(good: DataFrame, size: int) -> list[np.ndarray]:
    """The features of ``TREE_ROWS`` of the good rows for each tree, or of all if they are fewer.

    A tree takes the rows whose hashes with its number are smallest.  About twice as many are looked
    at, which always suffices.
    """
    rate = min(1.0, 2 * TREE_ROWS / size)
    trees = F.filter(F.sequence(F.lit(0), F.lit(TREES - 1)),
                     lambda tree: spread(tree, F.col("key")) < rate)
    place = Window.partitionBy("tree").orderBy(spread(F.col("tree"), F.col("key")), "stats")
    found = good.select("key", "stats", F.explode(trees).alias("tree")).withColumn(
        "place", F.row_number().over(place)).where(F.col("place") <= TREE_ROWS).orderBy(
            "tree", "place").select("tree", "stats").toArrow().combine_chunks()
    x, tree = features(numbers(found["stats"].combine_chunks())), found["tree"].to_numpy()
    return [x[tree == k] for k in range(TREES)]


def leaf_counts(good: DataFrame, forest: Forest) -> np.ndarray:
    """How many of the good rows lie in each node, for each tree; only leaves have any."""
    shape = forest.left.shape

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, dtype=np.int64)
        for batch in batches:
            for tree, at in enumerate(forest.leaves(features(numbers(batch.column(0))))):
                total[tree] += np.bincount(at, minlength=shape[1])
        node = np.flatnonzero(total)
        yield pa.record_batch({"node": pa.array(node), "n": pa.array(total.ravel()[node])})

    found = good.select("stats").mapInArrow(count, "node bigint, n bigint").groupBy("node").agg(
        F.sum("n").alias("n")).toArrow()
    counts = np.zeros(shape[0] * shape[1])
    counts[found["node"].to_numpy()] = found["n"].to_numpy()
    return counts.reshape(shape)


def calibrate(rows: DataFrame, forest: Forest, n_good: int, n_bad: int) -> float:
    """The cut with the best sum of good rows kept and bad rows caught, good rows counting fourfold.

    Equal anomalies are counted first; the others are put in order part by part.
    """
    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(forest.anomaly(features(numbers(batch.column(0))))), batch.column(1)],
            ["anomaly", "good"])

    number = F.col("good").cast("bigint")
    cuts = stored(map_batches(rows.select("stats", "good"), judge, "anomaly double, good boolean")
                  .groupBy("anomaly").agg(F.sum(number).alias("good"), F.sum(1 - number).alias("bad"))
                  .withColumn("part", F.floor(F.col("anomaly") * PARTS)), "cuts")
    earlier, good, bad = [], 0, 0
    for r in cuts.groupBy("part").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).orderBy(
            "part").collect():
        earlier.append((r.part, good, bad))
        good, bad = good + r.good, bad + r.bad
    # From Arrow, as rows of Python objects would start Python workers of their own to be read.
    before = cuts.sparkSession.createDataFrame(pa.table(
        dict(zip(("part", "good_before", "bad_before"), map(pa.array, zip(*earlier))))))
    so_far = Window.partitionBy("part").orderBy("anomaly").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    kept = (F.col("good_before") + F.sum("good").over(so_far)) / n_good
    caught = 1 - (F.col("bad_before") + F.sum("bad").over(so_far)) / n_bad
    best = cuts.join(F.broadcast(before), "part").select(
        "anomaly", (4 * kept + caught).alias("gain")).orderBy(F.desc("gain"), "anomaly").first().anomaly
    following = cuts.where(F.col("anomaly") > best).agg(F.min("anomaly")).first()[0]
    return best if following is None else (best + following) / 2


def verdicts(texts: Iterable[str | None], model: QualityModel) -> dict[str, list | np.ndarray]:
    stats = np.array([text_statistics(t) for t in texts], dtype=np.int64).reshape(-1, WIDTH)
    failed = np.array([base_failed(s[0], s[4]) for s in stats], dtype=bool)
    anomaly = model.anomaly(stats)
    return {**{name: stats[:, i] for i, name in enumerate(BASE)}, "base_failed": failed,
            "anomaly": anomaly, "kept": ~failed & (anomaly <= model.threshold)}


def quality_rules(docs: DataFrame, model: QualityModel, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: id, base numbers, ``base_failed``, ``anomaly`` (0 to 1), ``kept``."""
    source = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = verdicts(texts_of(batch.column(1)), model)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *map(pa.array, found.values())], ["id", *found])

    numbers = ", ".join(f"{name} bigint" for name in BASE)
    judged = map_batches(source, judge, f"id {kind}, {numbers}, base_failed boolean, "
                                        "anomaly double, kept boolean")
    return judged.withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules and the forest keep, with all their columns."""
    flag = unused(docs, "kept")
    place = docs.columns.index(text_col)

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = verdicts(texts_of(batch.column(place)), model)["kept"]
        return batch.filter(pa.array(kept))

    return map_batches(docs.withColumn(flag, F.lit(True)), keep,
                       docs.withColumn(flag, F.lit(True)).schema).drop(flag)
