"""Toxicity scores from subword-bag embeddings and a softmax, trained together in numpy.

A word is the mean of the vectors of its character n-grams, taken with marks at its ends, so a word
never seen, or misspelt, shares the vectors of its parts.  A stretch of text is the mean of its
different words and goes through a linear softmax of two classes.  Stretches are windows over all
words, in their order, of several sizes, and the whole document: a passage in a long text weighs as
much as in a short one, and so do words strewn over a text.  Each size has its own border, and a
document counts by the stretch that is furthest beyond it.

Embeddings and softmax are trained together.  They start from how much more of a toxic document than
of a clean one has an n-gram, and learn in several turns from whole documents and from the windows of
theirs that the model so far finds most toxic.  A row of an n-gram moves the faster the clearer its
start is.  N-grams of few documents say nothing.  As the softmax has two
classes, what a fitted n-gram adds is one number; it is averaged over several trainings, and scoring
adds these numbers.

Null and empty texts, and texts without words, get the score of an empty window.  Without labels of
both kinds all scores are the share of toxic labels, or 0.  Rows are scored one by one, so repeated
rows and ids give repeated results.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .batches import column, map_batches, spread, texts_of

WORD = re.compile(r"\w+")
SHORTEST, LONGEST = 3, 6
BUCKETS = 1 << 18
DIMENSIONS = 4
#: Words of the windows, the last being whole documents; shorter stretches are filled up with
#: nothing to LEAST words.
SIZES = (128, None)
LEAST = 64
#: An n-gram counts if it is in so many of the documents learned from.
LEAST_DOCUMENTS = 10
#: Trainings whose results are averaged, turns of each, and stretches of a step.
SEEDS, EPOCHS, BATCH = 2, 4, 64
#: The first step along the mean slope; it falls to 0 in a straight line.  Rows of n-grams go that
#: far times the size of their start, the softmax a small part of it.
STEP, SOFTMAX_PACE = 2000.0, 0.0001
#: At most about so many labelled documents of each class are learned from.
FIT_DOCUMENTS = 2_000
#: Scores of words that a worker remembers.
REMEMBERED = 300_000

PRIME = np.uint32(16777619)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram buckets of all words, one after the other, and how many each word has."""
    text = "".join([f"<{word}>" for word in words])
    char = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    length = np.array([len(word) + 2 for word in words])
    end = np.repeat(np.cumsum(length), length)
    word = np.repeat(np.arange(len(words)), length)
    place = np.arange(len(char))
    code = np.full(len(char), 2166136261, dtype=np.uint32)
    owners, buckets = [], []
    for size in range(1, LONGEST + 1):
        fits = place + size <= end
        place, word, end, code = place[fits], word[fits], end[fits], code[fits]
        code = (code ^ char[place + size - 1]) * PRIME
        if size >= SHORTEST:
            owners.append(word)
            buckets.append((code ^ (code >> np.uint32(15))) % np.uint32(BUCKETS))
    owner, bucket = np.concatenate(owners), np.concatenate(buckets).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.bincount(owner, minlength=len(words))


def means(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Means of runs of ``values``; every run has members."""
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    shape = (-1,) + (1,) * (values.ndim - 1)
    return np.add.reduceat(values, starts, axis=0) / counts.reshape(shape)


@dataclass
class ToxicityModel:
    """What each n-gram bucket adds to the log odds of a stretch, and the border of each size."""

    gram: np.ndarray
    borders: np.ndarray
    units: np.ndarray = field(default_factory=lambda: np.ones(len(SIZES)))
    words: dict[str, float] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"gram": self.gram, "borders": self.borders, "units": self.units, "words": {}}

    def learn_words(self, words: set[str]) -> None:
        if len(self.words) > REMEMBERED:
            self.words.clear()
        new = [word for word in words if word not in self.words]
        for start in range(0, len(new), 50_000):
            part = new[start:start + 50_000]
            bucket, counts = ngrams(part)
            self.words.update(zip(part, means(self.gram[bucket], counts).tolist()))

    def tops(self, text: str | None) -> np.ndarray:
        """The highest odds of the stretches of each size; 0 without words."""
        words = words_of(text)
        if not words:
            return np.zeros(len(SIZES))
        known = self.words
        try:
            values = [known[word] for word in words]
        except KeyError:
            self.learn_words(set(words))
            values = [self.words[word] for word in words]
        before = earlier(words)
        return np.array([stretch_means(np.array(values), before, size).max() for size in SIZES])

    def score(self, text: str | None) -> float:
        """Probability that the document is toxic."""
        odds = float(((self.tops(text) - self.borders) / self.units).max())
        return float(1 / (1 + np.exp(-np.clip(odds, -30, 30))))


def earlier(words: list) -> np.ndarray:
    """Where each word stood last, -1 if it is there for the first time."""
    last: dict = {}
    before = []
    for place, word in enumerate(words):
        before.append(last.get(word, -1))
        last[word] = place
    return np.array(before)


def stretch_means(values: np.ndarray, before: np.ndarray, size: int | None) -> np.ndarray:
    """The mean over the different words of each window; windows overlap by half, so that no group
    of words is cut by all of them.  A word counts where it is first in the window."""
    n = len(values)
    if size is None or size >= n:
        first = before < 0
        return np.array([values[first].sum() / max(int(first.sum()), LEAST)])
    half = size // 2
    at = np.arange(n)
    window, count = at // half, -(-(n - half) // half)
    total, number = np.zeros(count), np.zeros(count)
    for back in (0, 1):
        own = window - back
        fits = (own >= 0) & (own < count) & (before < own * half)
        total += np.bincount(own[fits], values[fits], count)
        number += np.bincount(own[fits], minlength=count)
    return total / np.maximum(number, LEAST)


def train(texts: list[str | None], toxic: np.ndarray, seed: int = 5) -> ToxicityModel:
    """Fit embeddings and softmax on whole documents; the order of the rows does not matter.

    A fifth of them only serves to place the borders.
    """
    order = sorted(range(len(texts)), key=lambda i: (texts[i] or "", bool(toxic[i])))
    apart = order[::5] if len(order) >= 100 else order
    order = [i for k, i in enumerate(order) if k % 5] if len(order) >= 100 else order
    vocabulary: dict[str, int] = {}
    docs = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(texts[i])],
                     dtype=np.int64) for i in order]
    label = np.asarray(toxic, dtype=float)[order]
    label, docs = label[[len(d) > 0 for d in docs]], [d for d in docs if len(d)]
    if not len(docs) or label.min() == label.max():
        share = float(np.mean(toxic)) if len(toxic) else 0.0
        odds = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
        return ToxicityModel(np.zeros(BUCKETS, np.float32), np.full(len(SIZES), -odds))
    grams = Grams(list(vocabulary))
    begin = first_guess(grams, docs, label)
    gram = np.mean([fit_grams(grams, begin, docs, label, seed + k) for k in range(SEEDS)], axis=0)
    model = ToxicityModel(gram.astype(np.float32), np.zeros(len(SIZES)))
    calibrate(model, [texts[i] for i in apart], np.asarray(toxic, dtype=bool)[apart])
    return model


class Grams:
    """The n-gram buckets of numbered words."""

    def __init__(self, vocabulary: list[str]):
        parts = [ngrams(vocabulary[a:a + 50_000]) for a in range(0, len(vocabulary), 50_000)]
        self.bucket = np.concatenate([b.astype(np.int32) for b, _ in parts])
        self.counts = np.concatenate([n for _, n in parts])
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the words one after the other, and how many each word has."""
        counts = self.counts[words]
        place = np.repeat(self.starts[words], counts) + (
            np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
        return self.bucket[place], counts

    def odds(self, gram: np.ndarray) -> np.ndarray:
        """What each word adds to the odds."""
        ends = [*range(50_000, len(self.counts), 50_000), len(self.counts)]
        return np.concatenate([means(gram[self.bucket[self.starts[a]:self.starts[b]]],
                                     self.counts[a:b]) for a, b in zip([0, *ends], ends)])


def first_guess(grams: Grams, docs: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    """The cube of the log of how much more of a toxic document's words have an n-gram; 0 for rare
    ones.  The cube lets few clear n-grams weigh more than many unclear ones."""
    share, seen, total = np.zeros((2, BUCKETS)), np.zeros(BUCKETS), np.zeros(2)
    for doc, toxic_doc in zip(docs, label.astype(int)):
        words = np.unique(doc)
        found, times = np.unique(grams.of(words)[0], return_counts=True)
        seen[found] += 1
        share[toxic_doc, found] += times / max(len(words), LEAST)
        total[toxic_doc] += 1
    share /= total[:, None]
    ratio = np.log((share[1] + 1e-4) / (share[0] + 1e-4)) ** 3
    ratio[seen < min(LEAST_DOCUMENTS, 1 + len(docs) // 20)] = 0
    return ratio / max(np.abs(ratio).max(), 1e-9)


def fit_grams(grams: Grams, begin: np.ndarray, docs: list[np.ndarray], label: np.ndarray,
              seed: int) -> np.ndarray:
    """What each n-gram bucket adds to the odds, by one training from ``begin``; ``docs`` hold
    numbers of words."""
    rng = np.random.default_rng(seed)
    # Steps in proportion to how clear an n-gram is: the many unclear ones would learn the texts by
    # heart.
    rate = np.abs(begin)[:, None]
    embedding = rng.uniform(-0.01, 0.01, (BUCKETS, DIMENSIONS)) * (rate > 0)
    embedding[:, 0] += begin
    weight = rng.uniform(-0.1, 0.1, (2, DIMENSIONS))
    weight[:, 0] += [-10, 10]
    # Stretches count as clean until their words speak against it, so words never seen say nothing.
    bias = np.array([1.0, -1.0])
    before = [earlier(doc.tolist()) for doc in docs]
    for epoch in range(EPOCHS):
        word_odds = grams.odds(embedding @ (weight[1] - weight[0]))
        stretches, target = [], []
        for doc, last, toxic_doc in zip(docs, before, label.astype(int)):
            for size in SIZES:
                if size is None or size < len(doc):
                    at = int(stretch_means(word_odds[doc], last, size).argmax()) * ((size or 0) // 2)
                    stretches.append(np.unique(doc[at:at + (size or len(doc))]))
                    target.append(toxic_doc)
        target = np.array(target)
        # Both classes weigh the same.
        balance = len(target) / 2 / np.maximum(np.bincount(target, minlength=2), 1)[target]
        turn = rng.permutation(len(stretches))
        for a in range(0, len(turn), BATCH):
            some = turn[a:a + BATCH]
            pace = STEP * (1 - (epoch + a / len(turn)) / EPOCHS) / len(some)
            size = np.array([len(stretches[i]) for i in some])
            words, at = np.unique(np.concatenate([stretches[i] for i in some]), return_inverse=True)
            found, counts = grams.of(words)
            divisor = np.maximum(size, LEAST)[:, None]
            hidden = np.add.reduceat(means(embedding[found], counts)[at],
                                     np.cumsum(size) - size, axis=0) / divisor
            odds = hidden @ weight.T + bias
            p = np.exp(odds - odds.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(some)), target[some]] -= 1
            p *= balance[some][:, None]
            slope = np.repeat((p @ weight) / divisor, size, axis=0)
            for k in range(DIMENSIONS):
                step = np.bincount(at, slope[:, k], len(words)) / counts
                embedding[:, k] -= pace * rate[:, 0] * np.bincount(
                    found, np.repeat(step, counts), BUCKETS)
            weight -= pace * SOFTMAX_PACE * (p.T @ hidden)
            bias -= pace * SOFTMAX_PACE * p.sum(axis=0)
    return embedding @ (weight[1] - weight[0])


def calibrate(model: ToxicityModel, texts: list[str | None], toxic: np.ndarray) -> None:
    """Place the borders: that of each size beyond nearly all clean documents, and all together so
    that 0.5 divides the documents with few errors of both classes, false ones counting twice.
    """
    if toxic.all() or not toxic.any():
        return
    tops = np.array([model.tops(text) for text in texts])
    model.borders = np.quantile(tops[~toxic], 0.99, axis=0)
    model.units = np.maximum(np.median(tops[toxic], axis=0) - model.borders, 1e-6)
    odds = ((tops - model.borders) / model.units).max(axis=1)
    rank = np.argsort(odds, kind="stable")
    value, positive = odds[rank], toxic[rank]
    missed = np.concatenate([[0], np.cumsum(positive)]) / positive.sum()
    false = 1 - np.concatenate([[0], np.cumsum(~positive)]) / (~positive).sum()
    errors = missed + 2 * false
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    cut = int(best[len(best) // 2])
    low = value[cut - 1] if cut else value[0] - 1
    high = value[cut] if cut < len(value) else value[-1] + 1
    model.borders = model.borders + model.units * (low + high) / 2


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: Column | None = None,
                 id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
                 label_col: str = "toxic", documents: int = FIT_DOCUMENTS) -> ToxicityModel:
    """Learn from about ``documents`` labelled rows of each class, chosen by a hash of their ids.

    ``learn`` restricts the rows of ``labels``.  Of the clean class twice as many are taken.
    """
    usable = labels.select(
        column(label_id).alias("id"), (column(label_col) > 0).alias("toxic"),
        (F.lit(True) if learn is None else learn).alias("learn")).where("learn").drop("learn").dropna()
    size = {r.toxic: r["count"] for r in usable.groupBy("toxic").count().collect()}
    rate = F.when(F.col("toxic"), documents / size.get(True, 1)).otherwise(
        2 * documents / size.get(False, 1))
    chosen = usable.where(spread(F.col("id")) < rate)
    # At most about three times ``documents`` ids: small enough to send to every executor.
    sample = docs.select(column(id_col).alias("id"), column(text_col).alias("text")).join(
        F.broadcast(chosen), "id").select("text", "toxic").toArrow()
    return train(sample["text"].to_pylist(), np.array(sample["toxic"].to_pylist(), dtype=bool))


def toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per document: id, ``score`` and ``predicted``."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shipped.value
        score = np.array([model.score(text) for text in texts_of(batch.column(1))])
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
            ["id", "score", "predicted"])

    return map_batches(source, judge, f"id {kind}, score double, predicted int") \
        .withColumnRenamed("id", id_col)
