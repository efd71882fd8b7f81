"""Best-fit packing of token sequences by a configuration linear program.

Only how many pieces there are of each length matters for the packing, at most one number for each
length up to the capacity, whatever the size of the corpus.  A configuration says how many pieces
of each length go into one sequence.  The linear program that covers all pieces with as few
configurations as possible is solved by multiplicative weights: each length has a price, a knapsack
dynamic program finds the configurations worth most, and prices of lengths that are covered faster
than others fall.  Uses are rounded to whole sequences as they are found, and what remains is priced
again.  The last few pieces, longest first, go where they fit
best.

Pieces are numbered within their length without a sort: each task counts its own, and the counts of
the tasks before it are added.  Their places in the plan are then found by number.

A null text is an empty one; each document has at least its end token, so each has a piece.  Rows
that share an id, or are repeated, are packed one by one.
"""

from __future__ import annotations

import base64
import bisect
import json
import struct
import zlib
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from millrace.workspace import stored

from .batches import column, map_batches, texts_of

CAPACITY = 2048
END = 0
ROUNDS = 60
#: Rounds without any use before the program ends.
IDLE_ROUNDS = 8
#: Shares of the pieces that are left to best fit, tried in turn.
RESTS = (0.04, 0.1, 0.25, 0.5)
#: A worker remembers between one and two times so many words.
REMEMBERED = 120_000
#: The character beyond which words are left to the slower library that defines the ids.
COMMON = "ɏ"


class WordTokens:
    """Ids of a byte-level tokenizer as bytes (four for each id), word by word.

    A space before a word starts a new token run, so texts are cut there and words are remembered.
    Words of common letters are encoded from the same vocabulary as ranks, which is several times
    faster; the tests hold both to the same ids.
    """

    def __init__(self, path: str, ranks_path: str | None = None, pattern: str | None = None):
        self.path, self.library, self.fast = path, None, None
        with open(path, encoding="utf-8") as file:
            self.special = [token["content"] for token in json.load(file).get("added_tokens", [])]
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as file:
                ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                                          special_tokens={})
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def exact(self, text: str) -> bytes:
        """The ids by the library itself, which is loaded when it is first needed."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _encode(self, text: str) -> bytes:
        if self.fast is None or not text.isascii() and max(text) > COMMON:
            return self.exact(text)
        ids = self.fast.encode_ordinary(text)
        return struct.pack(f"<{len(ids)}I", *ids)

    def remember(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self._encode(word)
        if len(self.words) >= REMEMBERED:
            self.older, self.words = self.words, {}
        self.words[word] = found
        return found

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(token in text for token in self.special):
            return self.exact(text)
        words, get = text.split(" "), self.words.get
        if "" in words or not text.isascii() and any(
                word[0].isspace() or word[-1].isspace() for word in words):
            return self._encode(text)  # white space next to a cut belongs together
        if text.isascii() and any(word[0] <= " " or word[-1] <= " " for word in words):
            return self._encode(text)
        out = [get(words[0]) or self.remember(words[0])]
        for word in words[1:]:
            word = " " + word
            out.append(get(word) or self.remember(word))
        return b"".join(out)


@lru_cache(maxsize=2)
def word_tokens(path: str, ranks_path: str | None, pattern: str | None) -> WordTokens:
    return WordTokens(path, ranks_path, pattern)


def cuts(total: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces; only the first may be short."""
    first = total % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, total, capacity)]


@dataclass
class Plan:
    """For each length, who goes where: parallel lists ordered by ``low``.

    Pieces numbered from ``low`` go to sequences from ``first`` on, ``per`` to each, the first of
    them at ``offset``.
    """

    capacity: int
    sequences: int = 0
    rows: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    used: dict[int, int] = field(default_factory=dict)

    def add(self, configuration: dict[int, int], times: int) -> None:
        offset = 0
        for length, per in sorted(configuration.items(), reverse=True):
            low = self.used.get(length, 0)
            high = low + per * times
            self.rows.append((length, low, high, self.sequences, per, offset))
            self.used[length] = high
            offset += per * length
        self.sequences += times


def best_fill(price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack: the best worth within each size, and the last length taken there (0: none)."""
    worth, last = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    for size in range(1, capacity + 1):
        offers = price[1:size + 1] + worth[size - 1::-1]
        k = int(offers.argmax())
        if offers[k] > worth[size - 1]:
            worth[size], last[size] = offers[k], k + 1
        else:
            worth[size] = worth[size - 1]
    return worth, last


def configuration(length: int, capacity: int, last: np.ndarray) -> dict[int, int]:
    """``length`` and the best fill of what it leaves."""
    taken, size = {length: 1}, capacity - length
    while size > 0:
        if last[size]:
            taken[int(last[size])] = taken.get(int(last[size]), 0) + 1
            size -= int(last[size])
        else:
            size -= 1
    return taken


def place_by_configurations(room: dict[int, int], capacity: int, plan: Plan, rounds: int, rng,
                            loose: bool) -> None:
    """Solve the linear program over configurations that fill a sequence, in whole uses.

    Each round prices the lengths, lets the knapsack find the best filling around each length, and
    uses each filling as often as the pieces left allow, rounded to whole sequences; the next round
    solves what remains.  A length that is covered faster than the others becomes cheaper,
    one that is not becomes dearer.  The weights differ so little that a filled sequence is worth
    more than one with room in it.  ``loose`` lets sequences keep room where nothing fills them, as
    little as there is a filling for.
    """
    weight, idle, gap = np.zeros(capacity + 1), 0, 0
    for _ in range(rounds):
        here = np.array(sorted(k for k, n in room.items() if n), dtype=np.int64)
        if not len(here) or idle > IDLE_ROUNDS:
            return
        price = np.full(capacity + 1, -np.inf)
        price[here] = here / capacity * np.exp(
            1e-3 * weight[here] + rng.uniform(-3e-4, 3e-4, len(here)))
        _, last = best_fill(price, capacity)
        allowed = {int(k): room[int(k)] for k in here}
        used, wider = dict.fromkeys(allowed, 0), capacity
        for length in here[::-1].tolist():
            taken = configuration(length, capacity, last)
            times = min((allowed[k] - used[k]) // per for k, per in taken.items())
            left = capacity - sum(k * per for k, per in taken.items())
            if times > 0 and left > gap:
                wider = min(wider, left)
            elif times > 0:
                plan.add(taken, times)
                for k, per in taken.items():
                    used[k] += per * times
        covered = np.array([used[k] / allowed[k] for k in here.tolist()])
        idle = idle + 1 if not covered.any() else 0
        if idle and loose:
            gap = wider
        weight[here] = np.clip(weight[here] + 0.3 * (covered.mean() - covered), -1, 1)
        for k, n in used.items():
            room[k] -= n


def make_plan(counts: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> Plan:
    """Where pieces go, given how many there are of each length.

    An even share of all lengths is left for best fit, which closes the last gaps with it; the share
    grows until no more sequences are needed than best fit alone takes.  Where filled sequences leave
    many pieces, the program goes on with sequences that keep some room, and the better plan counts.
    """
    counts = {k: n for k, n in counts.items() if n}
    full = counts.pop(capacity, 0)
    plain = Plan(capacity)
    best_fit(dict(counts), capacity, plain)
    best = None
    for rest in RESTS:
        for loose in (False, True):
            plan, room, kept = Plan(capacity), {}, 0.0
            for k in sorted(counts):
                before, kept = int(kept), kept + rest * counts[k]
                room[k] = counts[k] - (int(kept) - before)
            place_by_configurations(room, capacity, plan, rounds, np.random.default_rng(11), loose)
            left = {k: n - plan.used.get(k, 0) for k, n in counts.items()}
            best_fit({k: n for k, n in left.items() if n}, capacity, plan)
            if best is None or plan.sequences < best.sequences:
                best = plan
            if sum(room.values()) < 0.02 * sum(counts.values()):
                break
        if best.sequences <= plain.sequences:
            break
    best = best if best.sequences <= plain.sequences else plain
    if full:
        best.add({capacity: 1}, full)
    return best


def best_fit(left: dict[int, int], capacity: int, plan: Plan) -> None:
    """Longest pieces first, each into the sequence with the least room that takes it.

    Pieces of a length, and sequences filled alike, are placed by counts: a piece goes on filling
    the sequence of the piece before it while there is room.  Each length adds a few kinds of
    sequences at most, so the work depends on the number of lengths only.
    """
    rooms: list[int] = []
    open_at: dict[int, dict[tuple, int]] = {}

    def put(room: int, taken: tuple, times: int) -> None:
        if room not in open_at:
            bisect.insort(rooms, room)
            open_at[room] = {}
        open_at[room][taken] = open_at[room].get(taken, 0) + times

    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                taken, there = open_at[room].popitem()
                if not open_at[room]:
                    del open_at[room], rooms[at]
            else:
                room, taken, there = capacity, (), n
            per = min(room // length, n)
            times = min(n // per, there)
            put(room - per * length, (*taken, (length, per)), times)
            n -= per * times
            if there > times and taken:
                put(room, taken, there - times)
    for room in sorted(open_at):
        for taken, times in open_at[room].items():
            plan.add(dict(taken), times)


def cut_pieces(docs: DataFrame, tokenizer: str, ranks: str | None = None,
               pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text",
               capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents, with their task and their number within task and length."""
    source = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    end = np.array([END], dtype="<u4").tobytes()
    names = ["id", "piece", "start", "length", "ids_crc32", "ids", "task", "number"]

    def run(batches):
        tokens, task = word_tokens(tokenizer, ranks, pattern), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)

        def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
            take, rows = [], []
            for at, text in enumerate(texts_of(batch.column(1))):
                ids = tokens.ids(text) + end
                for piece, (start, length) in enumerate(cuts(len(ids) // 4, capacity)):
                    part = ids[4 * start:4 * (start + length)]
                    take.append(at)
                    rows.append((piece, start, length, zlib.crc32(part),
                                 np.frombuffer(part, "<i4") if keep_ids else None, task,
                                 seen[length]))
                    seen[length] += 1
            piece, start, length, crc, kept, tasks, number = zip(*rows)
            return pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(take)), pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()), pa.array(kept, pa.list_(pa.int32())),
                pa.array(tasks, pa.int32()), pa.array(number, pa.int64())], names)

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                yield cut(batch.slice(at, 500))

    return source.mapInArrow(run, f"id {kind}, piece int, start bigint, length bigint, "
                                  "ids_crc32 bigint, ids array<int>, task int, number bigint")


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None,
         id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         keep_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset, and with
    ``keep_ids`` the ids themselves.

    The pieces are stored once, as tokenizing them twice would cost more.
    """
    spark = docs.sparkSession
    pieces = stored(cut_pieces(docs, tokenizer, ranks, pattern, id_col, text_col, capacity,
                               keep_ids), "pieces")
    by_task = pieces.groupBy("task", "length").count()
    # One row for each length, at most ``capacity``.
    counts = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    plan = make_plan(counts, capacity)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1)
    first = by_task.select("task", "length",
                           F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    numbered = pieces.join(first, ["task", "length"]) \
        .withColumn("number", F.col("number") + F.col("before"))
    # The plan's size is bounded by the capacity, not by the corpus.
    shipped = spark.sparkContext.broadcast(np.array(sorted(plan.rows), dtype=np.int64).reshape(-1, 6))

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Each piece's row of the plan by binary search; rows are ordered by length and number."""
        at_length, low, _, first, per, at_offset = shipped.value.T
        length, number = (batch.column(batch.schema.names.index(name)).to_numpy()
                          for name in ("length", "number"))
        row = np.empty(len(length), dtype=np.int64)
        for k in np.unique(length):
            own = length == k
            start, end = np.searchsorted(at_length, [k, k + 1])
            row[own] = start + np.searchsorted(low[start:end], number[own], "right") - 1
        within = number - low[row]
        kept = [c for c, name in zip(batch.columns, batch.schema.names) if name != "number"]
        return pa.RecordBatch.from_arrays(
            [*kept, pa.array(first[row] + within // per[row]),
             pa.array(at_offset[row] + within % per[row] * length)],
            [*columns, "sequence_id", "offset"])

    columns = ["id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    schema = ", ".join(f"{name} {numbered.schema[name].dataType.simpleString()}" for name in columns)
    placed = map_batches(numbered.select(*columns, "number"), place,
                         schema + ", sequence_id bigint, offset bigint")
    return placed.select(F.col("id").alias(id_col), *columns[1:5], "sequence_id", "offset",
                         *columns[5:])
