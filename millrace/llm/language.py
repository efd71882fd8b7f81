"""Language identification by prediction by partial matching over bytes.

Each language has a tree of byte contexts of up to three bytes with the counts of what follows.  A
byte that a context has not seen is coded by an escape to the next shorter one, without the bytes
that the longer one has ruled out; below the empty context all bytes are equally likely.  With the
counts frozen, each context gives each byte a fixed length, so the length of a text in a language
is a sum of table entries: exact, over the whole text, and without state between documents.

Capital ASCII letters are read as small ones and digits as one sign; bytes that the training rows
use too rarely share one symbol and split its probability evenly.  A text that is null or has no
letter is ``und``, and so is every text if there is nothing to learn from.  Ties go to the language
that comes first in the alphabet.  Where only documents in a learned language are to stay, a text
whose code is much longer than those of rows that were held apart is in none.  Repeated rows and ids are judged row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .batches import column, map_batches, spread, texts_of, unused

ORDER = 3
#: Symbols; the last one stands for all bytes that have none of their own.
SYMBOLS = 64
#: About so many documents of each language are learned from.
FIT_DOCUMENTS = 1_500
UNKNOWN = "und"
#: A text is in no learned language if a byte takes so many times the bits that it takes in all but
#: a hundredth of the rows held apart; so many bits are free, as short texts tell little.
MARGIN, FREE_BITS = 1.3, 128
#: Languages with fewer rows held apart have no limit.
LEAST_APART = 10
#: Bytes of a text that are looked up at a time.
BLOCK = 1 << 20

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[48:58] = 48


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def codes(raw: bytes, symbol: np.ndarray) -> np.ndarray:
    """For each byte its context and itself as one number; a text starts after a line end."""
    s = np.empty(len(raw) + ORDER, dtype=np.int32)
    s[:ORDER] = symbol[10]
    s[ORDER:] = symbol[np.frombuffer(raw, dtype=np.uint8)]
    n = len(raw)
    return ((s[:n] * SYMBOLS + s[1:n + 1]) * SYMBOLS + s[2:n + 2]) * SYMBOLS + s[3:]


def lengths(counts: np.ndarray, grams: np.ndarray, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits for each symbol after each context of two symbols and after the seen ones of three.

    ``grams`` are codes of four symbols that were seen, ``counts`` how often; ``shared`` is the
    number of bytes behind the last symbol.  Returns the contexts of three symbols and the bits,
    with one row for each context of two first.
    """
    even = np.full(SYMBOLS, 1 / 256)
    even[-1] = shared / 256
    below = even[None, :] / even.sum()
    tables = []
    for order in range(ORDER + 1):
        width = SYMBOLS ** order
        context = grams // SYMBOLS % width
        seen = np.unique(context) if order == ORDER else np.arange(width)
        n = np.bincount(np.searchsorted(seen, context) * SYMBOLS + grams % SYMBOLS,
                        weights=counts, minlength=len(seen) * SYMBOLS).reshape(-1, SYMBOLS)
        total, kinds = n.sum(axis=1, keepdims=True), (n > 0).sum(axis=1, keepdims=True)
        shorter = below[seen % max(SYMBOLS ** (order - 1), 1)]
        rest = np.where(n > 0, 0, shorter)
        rest /= np.maximum(rest.sum(axis=1, keepdims=True), 1e-300)
        escape = np.where(kinds == SYMBOLS, 0, kinds / np.maximum(total + kinds, 1))
        p = np.where(total > 0, (1 - escape) * n / np.maximum(total, 1) + escape * rest, shorter)
        tables.append(p)
        below = p
    bits = -np.log2(np.concatenate(tables[-2:]))
    bits[:, -1] += np.log2(max(shared, 1))
    return seen, bits.astype(np.float32)


@dataclass
class LanguageModel:
    """``state`` maps a context of three symbols to a row of ``bits`` (state * symbol, language)."""

    names: list[str]
    symbol: np.ndarray
    state: np.ndarray
    bits: np.ndarray
    #: The most bits for a byte in each language, for :meth:`identified`.
    limits: np.ndarray | None = None

    def code_lengths(self, text: str) -> np.ndarray:
        """Bits of the whole text in each language."""
        raw = text.encode("utf-8", "surrogatepass")
        total = np.zeros(len(self.names))
        for start in range(0, len(raw), BLOCK):
            first = max(start - ORDER, 0)
            code = codes(raw[first:start + BLOCK], self.symbol)[start - first:]
            row = self.state[code // SYMBOLS] * SYMBOLS + code % SYMBOLS
            total += self.bits[row].sum(axis=0, dtype=np.float64)
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language with the shortest code, and its share of all languages' probability."""
        if not self.names or not has_letter(text):
            return UNKNOWN, 0.0
        bits = self.code_lengths(text)
        best = int(np.argmin(bits))
        return self.names[best], float(1 / np.exp2(np.minimum(bits[best] - bits, 0)).sum())

    def identified(self, text: str | None) -> bool:
        """Whether the text is in one of the languages, as far as there are limits."""
        if not self.names or not has_letter(text):
            return False
        if self.limits is None:
            return True
        best, rate = self.rate(text)
        return rate <= self.limits[best]

    def rate(self, text: str) -> tuple[int, float]:
        """The number of the best language and the bits for a byte beyond the free ones."""
        bits = self.code_lengths(text)
        best = int(np.argmin(bits))
        return best, float(bits[best] - FREE_BITS) / len(text.encode("utf-8", "surrogatepass"))


def fit_languages(docs: DataFrame, learn: Column | None = None, text_col: str = "text",
                  lang_col: str = "lang", id_col: str = "doc_id",
                  documents: int = FIT_DOCUMENTS, limits: bool = False) -> LanguageModel:
    """Learn from about ``documents`` rows of each language, chosen by a hash of their ids.

    ``learn`` restricts the rows.  Rows without language, or without a letter, teach nothing.  With
    ``limits`` a second model learns from one half of these rows and is measured on the other, so
    that :meth:`LanguageModel.identified` can reject texts in no language.
    """
    usable = docs.select(
        column(id_col).alias("id"), column(text_col).alias("text"), column(lang_col).alias("lang"),
        (F.lit(True) if learn is None else learn).alias("learn"),
    ).where("learn and lang is not null").drop("learn")
    size = {r.lang: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not size:
        return LanguageModel([], np.zeros(256, np.uint8), np.zeros(1, np.int32),
                             np.zeros((1, 0), np.float32))
    rate = F.create_map(*[F.lit(x) for lang, n in size.items() for x in (lang, documents / n)])
    sample = usable.where(spread(F.col("id")) < rate[F.col("lang")]).select(
        "lang", "text", ((spread(F.lit("apart"), F.col("id")) < 0.5) & F.lit(limits)).alias("apart"))

    def histogram(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: dict[str, np.ndarray] = {}
        for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
            raw = FOLD[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)]
            found[lang] = found.get(lang, 0) + np.bincount(raw, minlength=256)
        return pa.record_batch({"lang": list(found), "counts": [c.tolist() for c in found.values()]},
                               schema=pa.schema([("lang", pa.string()),
                                                 ("counts", pa.list_(pa.int64()))]))

    # At most 256 numbers for each language and batch of the sample.
    bytes_seen = map_batches(sample, histogram, "lang string, counts array<bigint>").select(
        F.posexplode("counts").alias("byte", "n")).groupBy("byte").agg(F.sum("n").alias("n"))
    order = sorted(((-r.n, r.byte) for r in bytes_seen.collect() if r.n))
    own = [byte for _, byte in order[:SYMBOLS - 1]]
    if 10 not in own:
        own = own[:SYMBOLS - 2] + [10]
    place = np.full(256, SYMBOLS - 1, dtype=np.uint8)
    place[own] = np.arange(len(own))
    symbol = place[FOLD]
    shared = len(set(FOLD.tolist())) - len(own)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        grams: dict[tuple[str, bool], list[np.ndarray]] = {}
        for lang, text, apart in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)),
                                     batch.column(2).to_pylist()):
            if has_letter(text):
                grams.setdefault((lang, apart), []).append(
                    codes(text.encode("utf-8", "surrogatepass"), symbol))
        parts = []
        for (lang, apart), arrays in grams.items():
            gram, n = np.unique(np.concatenate(arrays), return_counts=True)
            parts.append(pa.record_batch({"lang": pa.array([lang] * len(gram)),
                                          "apart": pa.array([apart] * len(gram)), "gram": gram,
                                          "n": n.astype(np.int64)}))
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if parts else None

    # The model: what was seen of four symbols, bounded by the alphabet and the sample.
    found = map_batches(sample, count, "lang string, apart boolean, gram int, n bigint").groupBy(
        "lang", "apart", "gram").agg(F.sum("n").alias("n")).toArrow()
    total = found.group_by(["lang", "gram"]).aggregate([("n", "sum")])
    model = build_model(total.rename_columns(["lang", "gram", "n"]), symbol, shared)
    learned = found.filter(pc.invert(found["apart"]))
    if limits and len(learned):
        model.limits = measure(sample.where("apart"), build_model(learned, symbol, shared), model.names)
    return model


def measure(sample: DataFrame, model: LanguageModel, names: list[str]) -> np.ndarray:
    """The limits of ``names``, by how long the rows of ``sample`` are in the best language."""
    shipped = sample.sparkSession.sparkContext.broadcast(model)

    def rates(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shipped.value.rate(text) for text in texts_of(batch.column(1)) if has_letter(text)]
        return pa.record_batch({
            "lang": pa.array([shipped.value.names[best] for best, _ in found], pa.string()),
            "rate": pa.array([rate for _, rate in found], pa.float64())})

    # One row for each language.
    usual = map_batches(sample, rates, "lang string, rate double").groupBy("lang").agg(
        F.expr("percentile(rate, 0.99)").alias("rate"), F.count("*").alias("n")).collect()
    found = {r.lang: MARGIN * max(r.rate, 0.0) for r in usual if r.n >= LEAST_APART}
    # Where all rows are short the free bits cover them, and what is left is no measure.
    return np.array([found.get(name) or np.inf for name in names])


def build_model(grams: pa.Table, symbol: np.ndarray, shared: int) -> LanguageModel:
    lang = np.array(grams["lang"].to_pylist(), dtype=object)
    gram, n = grams["gram"].to_numpy(), grams["n"].to_numpy()
    names = sorted(set(lang))
    two = SYMBOLS ** (ORDER - 1)
    every = np.unique(gram // SYMBOLS)
    state = (np.arange(SYMBOLS ** ORDER) % two).astype(np.int32)
    state[every] = two + np.arange(len(every))
    bits = np.empty((two + len(every), SYMBOLS, len(names)), dtype=np.float32)
    for k, name in enumerate(names):
        own = lang == name
        seen, table = lengths(n[own], gram[own], shared)
        bits[:two, :, k] = table[:two]
        bits[two:, :, k] = table[every % two]
        bits[two + np.searchsorted(every, seen), :, k] = table[two:]
    return LanguageModel(names, symbol, state, bits.reshape(-1, len(names)))


def languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """One row per document: id, ``lang_pred`` and ``score``."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shipped.value.predict(text) for text in texts_of(batch.column(1))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([f[0] for f in found], pa.string()),
             pa.array([f[1] for f in found], pa.float64())], ["id", "lang_pred", "score"])

    return map_batches(source, judge, f"id {kind}, lang_pred string, score double") \
        .withColumnRenamed("id", id_col)


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in a language of the model, with all their columns."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)
    flag = unused(docs, "kept")
    marked = docs.withColumn(flag, F.lit(True))

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shipped.value
        return batch.filter(pa.array([model.identified(text) for text in texts_of(batch.column(place))], pa.bool_()))

    return map_batches(marked, keep, marked.schema).drop(flag)
