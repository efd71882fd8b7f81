"""Runs of repeated words, found in a grammar of the text.

A run is a stretch of words with a smallest period ``q`` (words ``q`` apart are equal) that repeats
it four times at least, is six words long at least, and cannot be longer on either side.

The word ids are compressed by Re-Pair: the most frequent pair of neighbours becomes a new symbol
until no pair comes twice.  A run has one smallest part of the derivation that holds all of it, and
crosses the middle of that part.  So the runs that cross the border between the two halves of each
symbol are looked for once, however often the symbol comes; what is left after the last symbol is
halved the same way.  The places of all symbols with runs are then read off the grammar, and of the
stretches found for a period those that lie within another one are parts of it and go.

Before that the text is cut where no run can be: each word of a run stands there four times, each
pair of neighbours three times.

A null text, or one without words, has no words and no runs.  Rows are judged one by one, so
repeated rows and ids give repeated results.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .batches import column, map_batches, texts_of

#: A run repeats its period so often, and has so many words, at least.
REPEATS, SHORTEST = 4, 6

Run = tuple[int, int, int]


class Sequence:
    """Numbers in a row, for comparing stretches from left to right or, reversed, to the left."""

    def __init__(self, numbers: np.ndarray):
        self.numbers = np.ascontiguousarray(numbers, dtype="<i4")
        self.raw = self.numbers.tobytes()

    def common(self, i: int, j: int, limit: int) -> int:
        """How many numbers from ``i`` and from ``j`` on are equal, up to ``limit``."""
        raw, done, step = self.raw, 0, 16
        while done < limit:
            step = min(step, limit - done)
            a, b = 4 * (i + done), 4 * (j + done)
            if raw[a:a + 4 * step] != raw[b:b + 4 * step]:
                differ = (self.numbers[i + done:i + done + step]
                          != self.numbers[j + done:j + done + step])
                return done + int(differ.argmax())
            done += step
            step *= 2
        return limit

    def squares(self, start: int, end: int) -> list[int]:
        """The smallest periods of the squares that begin at ``start`` and lie before ``end``."""
        raw, most, periods, p = self.raw, (end - start) // 2, [], 1
        while p <= most:
            if p >= 2:
                # The next place with the same two numbers.
                p = self._next(start, start + p, start + most + 2) - start
                if p > most:
                    break
            elif raw[4 * start:4 * start + 4] != raw[4 * start + 4:4 * start + 8]:
                p = 2
                continue
            whole = p + self.common(start, start + p, end - start - p)
            if whole >= 2 * p:
                periods.append(p)
                # Up to here other squares only repeat this period.
                p = max(whole // 2, whole - p) + 1
            else:
                p += 1
        return periods

    def _next(self, start: int, low: int, high: int) -> int:
        """The first place from ``low`` on with the two numbers of ``start``; beyond ``high`` if
        there is none."""
        wanted, at = self.raw[4 * start:4 * start + 8], 4 * low
        while True:
            at = self.raw.find(wanted, at, 4 * high)
            if at < 0:
                return high + 1
            if at % 4 == 0:
                return at // 4
            at += 1


class Grammar:
    """Re-Pair over the numbers below ``alphabet``; ``ends`` are where stretches end.

    ``rules`` holds the two halves of each new symbol, ``first`` where it is first, ``root`` the
    symbols and places that are left of each stretch.
    """

    def __init__(self, numbers: list[int], ends: list[int], alphabet: int):
        n = len(numbers)
        self.alphabet = alphabet
        self.rules: list[tuple[int, int]] = []
        self.first: list[int] = []
        symbol, after, before = list(numbers), list(range(1, n + 1)), list(range(-1, n - 1))
        starts = [0, *ends[:-1]]
        for start, end in zip(starts, ends):
            before[start], after[end - 1] = -1, n
        places: dict[tuple[int, int], list[int]] = {}
        for i, j in enumerate(after):
            if j < n:
                places.setdefault((symbol[i], symbol[j]), []).append(i)
        # Of equally frequent pairs the older goes first, so symbols of one passage grow evenly.
        heap = [(-len(where), age, pair) for age, (pair, where) in enumerate(places.items())
                if len(where) > 1]
        heapq.heapify(heap)
        age = len(places)
        while heap:
            count, old, pair = heapq.heappop(heap)
            x, y = pair
            where, taken = [], -1
            for i in places.pop(pair):
                j = after[i]
                if i > taken and symbol[i] == x and j < n and symbol[j] == y:
                    where.append(i)
                    taken = j if x == y else -1
            if len(where) < 2:
                continue
            if len(where) < -count:
                places[pair] = where
                heapq.heappush(heap, (-len(where), old, pair))
                continue
            new, made = alphabet + len(self.rules), {}
            self.rules.append(pair)
            self.first.append(where[0])
            for i in where:
                j = after[i]
                k, h = after[j], before[i]
                symbol[i], symbol[j], after[i] = new, -1, k
                if k < n:
                    before[k] = i
                    made.setdefault((new, symbol[k]), []).append(i)
                if h >= 0:
                    made.setdefault((symbol[h], new), []).append(h)
            for pair, where in made.items():
                if len(where) > 1:
                    places[pair] = where
                    heapq.heappush(heap, (-len(where), age, pair))
                    age += 1
        self.root: list[list[tuple[int, int]]] = []
        for start, end in zip(starts, ends):
            own, i = [], start
            while i < n:
                own.append((symbol[i], i))
                i = after[i]
            self.root.append(own)
        self.size = [1] * alphabet
        for x, y in self.rules:
            self.size.append(self.size[x] + self.size[y])


class Runs:
    """The runs of ``numbers`` by the grammar, as (start, end, period)."""

    def __init__(self, numbers: np.ndarray, ends: list[int], alphabet: int):
        self.n, self.alphabet = len(numbers), alphabet
        self.right, self.left = Sequence(numbers), Sequence(numbers[::-1])
        self.grammar = Grammar(numbers.tolist(), ends, alphabet)
        self.ends = ends
        self.heads: dict[int, list[int]] = {}
        self.tails: dict[int, list[int]] = {}

    def crossing(self, low: int, middle: int, high: int, heads: list[int],
                 tails: list[int]) -> list[Run]:
        """Runs of ``low .. high`` with words on both sides of ``middle``.

        Half of such a run is on one side, so that side begins or ends in a square of the period.
        """
        spans = [(p, middle - self.left.common(self.n - middle, self.n - middle - p, middle - low),
                  middle + p + self.right.common(middle, middle + p, high - middle - p))
                 for p in heads]
        spans += [(p, middle - p - self.left.common(
                      self.n - middle + p, self.n - middle, middle - p - low),
                   middle + self.right.common(middle - p, middle, high - middle))
                  for p in tails]
        found: list[Run] = []
        # A stretch that some smaller period repeats is a run of that one.
        for p, start, end in sorted(set(spans)):
            if start < middle < end and end - start >= max(SHORTEST, REPEATS * p) and not any(
                    s <= start and end <= e and p % q == 0 for s, e, q in found):
                found.append((start, end, p))
        return found

    def head(self, symbol: int, start: int) -> list[int]:
        if symbol not in self.heads:
            self.heads[symbol] = self.right.squares(start, start + self.grammar.size[symbol])
        return self.heads[symbol]

    def tail(self, symbol: int, end: int) -> list[int]:
        if symbol not in self.tails:
            at = self.n - end
            self.tails[symbol] = self.left.squares(at, at + self.grammar.size[symbol])
        return self.tails[symbol]

    def of_symbols(self) -> list[list[Run]]:
        """The runs that cross the halves of each symbol, from its start."""
        size, found = self.grammar.size, []
        for (x, y), start in zip(self.grammar.rules, self.grammar.first):
            middle = start + size[x]
            heads, tails = self.head(y, middle), self.tail(x, middle)
            own = self.crossing(start, middle, middle + size[y], heads, tails) \
                if heads or tails else []
            found.append([(s - start, e - start, p) for s, e, p in own])
        return found

    def of_root(self) -> list[Run]:
        """The runs that cross the halves of what is left, which are halved again."""
        found = []
        for own, end in zip(self.grammar.root, self.ends):
            places = [at for _, at in own] + [end]
            parts = [(0, len(own))]
            while parts:
                a, b = parts.pop()
                if b - a < 2:
                    continue
                half = (a + b) // 2
                low, middle, high = places[a], places[half], places[b]
                heads = self.right.squares(middle, high)
                tails = self.left.squares(self.n - middle, self.n - low)
                if heads or tails:
                    found += self.crossing(low, middle, high, heads, tails)
                parts += [(a, half), (half, b)]
        return found

    def all(self) -> list[Run]:
        """The runs of symbols at all their places, with those of the root, without parts."""
        rules, size, own = self.grammar.rules, self.grammar.size, self.of_symbols()
        holds = [False] * self.alphabet
        for (x, y), runs in zip(rules, own):
            holds.append(bool(runs) or holds[x] or holds[y])
        places: dict[int, list[np.ndarray]] = {}
        for left in self.grammar.root:
            for symbol, at in left:
                if holds[symbol]:
                    places.setdefault(symbol, []).append(np.array([at]))
        by_period: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for symbol in range(self.alphabet + len(rules) - 1, self.alphabet - 1, -1):
            if symbol not in places:
                continue
            at = np.concatenate(places.pop(symbol))
            x, y = rules[symbol - self.alphabet]
            for start, end, p in own[symbol - self.alphabet]:
                by_period.setdefault(p, []).append((at + start, at + end))
            if holds[x]:
                places.setdefault(x, []).append(at)
            if holds[y]:
                places.setdefault(y, []).append(at + size[x])
        for start, end, p in self.of_root():
            by_period.setdefault(p, []).append((np.array([start]), np.array([end])))
        found = []
        for p, parts in by_period.items():
            start, end = (np.concatenate(side) for side in zip(*parts))
            order = np.lexsort((-end, start))
            start, end = start[order], end[order]
            whole = end > np.concatenate([[-1], np.maximum.accumulate(end)[:-1]])
            found += [(s, e, p) for s, e in zip(start[whole].tolist(), end[whole].tolist())]
        return found


def possible(ids: np.ndarray) -> list[tuple[int, int]]:
    """The stretches in which runs may be: words four times, pairs three times, until all are."""
    number = np.int64(ids.max()) + 1
    keep = np.flatnonzero(np.bincount(ids)[ids] >= REPEATS)
    at = keep[:-1][np.diff(keep) == 1] if len(keep) else keep
    while len(at) >= SHORTEST - 1:
        _, inverse, counts = np.unique(ids[at] * number + ids[at + 1], return_inverse=True,
                                       return_counts=True)
        often = counts[inverse] >= REPEATS - 1
        # A stretch needs enough pairs in a row.
        at = at[often]
        border = np.flatnonzero(np.diff(at) != 1) + 1
        first, last = np.concatenate([[0], border]), np.concatenate([border, [len(at)]])
        long = last - first >= SHORTEST - 1
        if often.all() and long.all():
            return list(zip(at[first].tolist(), (at[last - 1] + 2).tolist()))
        at = at[np.repeat(long, last - first)] if len(at) else at
    return []


def runs_of(words: list) -> list[Run]:
    """``(start, length, period)`` of all runs, by start and then period."""
    if len(words) < SHORTEST:
        return []
    number = {word: i for i, word in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
    stretches = possible(ids)
    if not stretches:
        return []
    places = np.concatenate([np.arange(a, b) for a, b in stretches])
    ends = np.cumsum([b - a for a, b in stretches]).tolist()
    _, own = np.unique(ids[places], return_inverse=True)
    found = Runs(own, ends, int(own.max()) + 1).all()
    return sorted((int(places[s]), e - s, p) for s, e, p in found)


def dropped(runs: list[Run], n: int) -> np.ndarray:
    """Which of ``n`` words some run holds after its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) > 0


def best_run(runs: list[Run]) -> Run | None:
    """The run that repeats its period most often; then the first, then the shortest period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_words``, its ``runs`` by start and period, the ``best`` of them
    (null without runs) and ``collapsed``, the words with each run's first period only."""
    source = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

    def named(r: Run | None) -> dict | None:
        return r and {"start": r[0], "length": r[1], "period": r[2]}

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, found, best, collapsed = [], [], [], []
        for text in texts_of(batch.column(1)):
            # Splits at the ASCII white space and nothing else.
            words = (text or "").encode("utf-8", "surrogatepass").split()
            runs = runs_of(words)
            sizes.append(len(words))
            found.append([*map(named, runs)])
            best.append(named(best_run(runs)))
            if runs:
                words = [w for w, out in zip(words, dropped(runs, len(words)).tolist()) if not out]
            collapsed.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(run)),
             pa.array(best, run), pa.array(collapsed, pa.string())],
            ["id", "n_words", "runs", "best", "collapsed"])

    fields = "struct<start:bigint,length:bigint,period:bigint>"
    return map_batches(source, judge, f"id {kind}, n_words bigint, runs array<{fields}>, "
                                      f"best {fields}, collapsed string") \
        .withColumnRenamed("id", id_col)
