"""Alignment of two tokenizers, with the documents of each linked pair counted by external spills.

A byte-level tokenizer (A) and a piece tokenizer (B) cut the same bytes.  Byte offsets where both
end a token cut the tokens into groups; a token of A and one of B are linked where their bytes
overlap.  Both start a token at each space that follows another character, so texts are cut there
and the alignment of a stretch is remembered.

How many documents hold a pair linked is counted outside of memory.  Each task collects records
(pair, document) and, when it has enough, sorts them and writes them as one run: the pairs by radix
of their A side, each radix a column of its own, all packed with zstd.  The runs of a radix are
merged by a heap, in as many levels as a bounded fan-in needs, which adds up each pair's count;
pairs come side-major, so the highest count of an A id is known as soon as its last pair is
through.  The counts are then streamed back to the runs they came from, run by run, and each run
adds them up for its documents.  A pair is one record per run whatever the number of documents, so a
hot token is no hot key, and a run is a bounded number of records.

Null and empty texts, and texts that a side does not give back byte by byte (such as those with
U+2581), have no tokens: all numbers are 0 and the groups are empty.  Rows that share an id, or are
repeated, are documents of their own.  Strings of special tokens are plain text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.workspace import stored

from .batches import column, texts_of

SPACE = "▁"
#: Bits of an id of B, and of the radix; ids of A have 16 bits.
LOW_BITS, RADIX_BITS, HIGH_BITS = 15, 7, 16
#: Most records of a run and documents in it, and runs that are merged at a time.
RUN_LINKS, RUN_DOCS, FAN_IN = 4_000_000, 50_000, 256
#: A worker remembers between one and two times so many stretches.
REMEMBERED = 150_000
#: The character beyond which A leaves stretches to the slower library that defines the ids.
COMMON = "ɏ"
#: Odd, so that ids of A are spread over the radixes without two of them becoming one.
SPREAD = 40_503

CUT = re.compile(r"(?<=\S)(?= )")
PIECE_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes: printable ones stand for
    themselves, the others for the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class TwoTokenizers:
    """Aligns stretches of text; see :func:`tokenizers_of`."""

    def __init__(self, json_path: str, ranks_path: str, pattern: str, model_path: str):
        import sentencepiece
        import tiktoken

        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
        self.json_path, self.library, self.a_bytes = json_path, None, None
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                                      special_tokens={})
        self.ranks = {rank: word for word, rank in ranks.items()}
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=model_path)
        if self.pieces.get_piece_size() > 1 << LOW_BITS:
            raise ValueError(f"B may have {1 << LOW_BITS} ids")
        self.b_bytes = [self._piece(i) for i in range(self.pieces.get_piece_size())]
        self.known: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        byte = PIECE_BYTE.fullmatch(piece) if self.pieces.is_byte(i) else None
        return bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE, " ").encode()

    def _exact(self, text: str) -> tuple[list[int], list[bytes]]:
        """Ids and bytes of A by the library, which is loaded when it is first needed."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.json_path)
            self.library.encode_special_tokens = True
            letters = byte_letters()
            self.a_bytes = {i: bytes(map(letters.__getitem__, token))
                            for token, i in self.library.get_vocab(with_added_tokens=False).items()
                            if all(letter in letters for letter in token)}
            if max(self.a_bytes) >= 1 << HIGH_BITS:
                raise ValueError(f"A may have {1 << HIGH_BITS} ids")
        ids = self.library.encode(text, add_special_tokens=False).ids
        return ids, [self.a_bytes[i] for i in ids]

    def align(self, text: str) -> tuple | None:
        """Numbers of A tokens, B tokens and groups, links and groups of a stretch that starts with
        the space before it; None if a side does not give its bytes back.

        Links are numbers of A (spread) and B, four bytes each.
        """
        if max(text) > COMMON:
            a, a_parts = self._exact(text)
        else:
            a = self.fast.encode_ordinary(text)
            a_parts = [self.ranks[i] for i in a]
        # B puts a space first by itself, but not before nothing, as at the end of a text.
        b = self.pieces.encode(text[1:]) if len(text) > 1 else [self.pieces.piece_to_id(SPACE)]
        b_parts = [self.b_bytes[i] for i in b]
        whole = text.encode("utf-8", "surrogatepass")
        if b"".join(a_parts) != whole or b"".join(b_parts) != whole:
            return None
        links, groups, i, j = [], [], 0, 0
        from_a, from_b, end_a, end_b = 0, 0, len(a_parts[0]), len(b_parts[0])
        while True:
            links.append((a[i] * SPREAD & 0xFFFF) << LOW_BITS | b[j])
            step_a, step_b = end_a <= end_b, end_b <= end_a
            if step_a:
                i += 1
            if step_b:
                j += 1
            if step_a and step_b:
                groups.append(",".join(map(str, a[from_a:i])) + "|" + ",".join(map(str, b[from_b:j])))
                from_a, from_b = i, j
                if i == len(a):
                    break
                end_a += len(a_parts[i])
                end_b += len(b_parts[j])
            elif step_a:
                end_a += len(a_parts[i])
            else:
                end_b += len(b_parts[j])
        return len(a), len(b), len(groups), struct.pack(f"<{len(links)}I", *links), ";".join(groups)

    def remember(self, text: str) -> tuple | None:
        found = self.older[text] if text in self.older else self.align(text)
        # Long stretches seldom come again.
        if len(text) <= 200:
            if len(self.known) >= REMEMBERED:
                self.older, self.known = self.known, {}
            self.known[text] = found
        return found

    def document(self, text: str | None) -> tuple[int, int, int, list[bytes], list[str]] | None:
        """Numbers of tokens and groups, links and groups of a whole text; None without tokens."""
        if not text:
            return None
        if "  " in text or not text.isascii() or text[0] <= " " or any(
                c in text for c in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"):
            parts = CUT.split(" " + text)
        else:
            parts = [" " + word for word in text.split(" ")]
            if parts[-1] == " ":
                # A space at the end is a stretch of its own.
                parts = CUT.split(" " + text)
        known = self.known
        found = [known[part] if part in known else self.remember(part) for part in parts]
        if None in found:
            return None
        a, b, groups, links, text_of = zip(*found)
        return sum(a), sum(b), sum(groups), links, text_of


@lru_cache(maxsize=1)
def tokenizers_of(*paths: str) -> TwoTokenizers:
    """One pair of tokenizers per worker: paths of A's file, A's ranks, A's pattern and B's model."""
    return TwoTokenizers(*paths)


KINDS = ("<u1", "<u2", "<u4", "<u8")


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as the largest needs, packed with zstd."""
    top = int(numbers.max()) if len(numbers) else 0
    kind = next(k for k, name in enumerate(KINDS) if top <= np.iinfo(name).max)
    raw = numbers.astype(KINDS[kind]).tobytes()
    return bytes([kind]) + zstandard.ZstdCompressor(level=1).compress(raw)


def unpacked(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data[1:])
    return np.frombuffer(raw, KINDS[data[0]]).astype(np.int64)


def packed_rising(numbers: np.ndarray) -> bytes:
    return packed(np.diff(numbers, prepend=numbers.dtype.type(0)))


def unpacked_rising(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data))


def starts_of(numbers: np.ndarray) -> np.ndarray:
    """Where a number differs from the one before it, the first included."""
    differs = np.ones(len(numbers), dtype=bool)
    differs[1:] = numbers[1:] != numbers[:-1]
    return np.flatnonzero(differs)


class Run:
    """Records (pair, document) of the documents seen since the last run."""

    def __init__(self):
        self.links: list[bytes] = []
        self.sizes: list[int] = []
        self.size = 0

    def add(self, links: tuple[bytes, ...]) -> int:
        """Take a document's links; returns how many there are."""
        joined = b"".join(links)
        self.links.append(joined)
        self.sizes.append(len(joined) // 4)
        self.size += len(joined) // 4
        return len(joined) // 4

    def full(self) -> bool:
        return self.size >= RUN_LINKS or len(self.sizes) >= RUN_DOCS

    def spilled(self) -> tuple[list[tuple[int, bytes, bytes]], bytes, bytes, bytes]:
        """Pairs and their documents' number of each radix; then for all pairs in their order that
        number, the documents, and how often a document has the pair."""
        pair = np.frombuffer(b"".join(self.links), "<u4").astype(np.uint64)
        doc = np.repeat(np.arange(len(self.sizes), dtype=np.uint64), self.sizes)
        record = pair << np.uint64(32) | doc
        del pair, doc
        record.sort()
        first = starts_of(record)
        times = np.diff(np.append(first, len(record)))
        record = record[first]
        pair, doc = record >> np.uint64(32), (record & np.uint64(0xFFFFFFFF)).astype(np.int64)
        del record
        start = starts_of(pair)
        docs = np.diff(np.append(start, len(pair)))
        pair = pair[start].astype(np.int64)
        radix = pair >> (HIGH_BITS + LOW_BITS - RADIX_BITS)
        cuts = np.searchsorted(radix, np.arange((1 << RADIX_BITS) + 1))
        parts = [(k, packed_rising(pair[a:b]), packed(docs[a:b]))
                 for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]
        # Steps from one document to the next of a pair, modulo their number, are small.
        steps = np.diff(doc, prepend=0) % max(len(self.sizes), 1)
        return parts, packed(docs), packed(steps), packed(times)


def merged(runs: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of all runs in order, their counts, and whether these are their A id's highest.

    A heap holds the next pair of each run.  Pairs of an A id follow each other, so the highest
    count is settled when the next A id begins.
    """
    streams = [zip(unpacked_rising(pairs).tolist(), unpacked(counts).tolist())
               for pairs, counts in runs]
    keys, totals, last = [], [], -1
    for key, count in heapq.merge(*streams):
        if key == last:
            totals[-1] += count
        else:
            keys.append(key)
            totals.append(count)
            last = key
    keys, totals = np.array(keys, dtype=np.int64), np.array(totals, dtype=np.int64)
    side = np.flatnonzero(np.diff(keys >> LOW_BITS, prepend=-1))
    highest = np.maximum.reduceat(totals, side) if len(side) else totals
    return keys, totals, totals == np.repeat(highest, np.diff(np.append(side, len(keys))))


def collected(docs: DataFrame, tokenizers: tuple[str, ...], id_col: str, text_col: str) -> DataFrame:
    """The runs as a stored table: a row for each document, for each run and for each radix of it.

    ``kind`` is ``doc``, ``run`` or ``pairs``.  Spills come out as rows, so a lost task writes them
    again and nothing lies on a machine of its own.
    """
    source = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, task, number, current, rows = tokenizers_of(*tokenizers), TaskContext.get(
        ).partitionId(), 0, Run(), []
        id_type = None

        def out(kinds: str, ids: pa.Array, **columns) -> pa.RecordBatch:
            n = len(ids)
            arrays = [ids, pa.array([kinds] * n), pa.array([task << 32 | number] * n, pa.int64())]
            for name, type_ in FIELDS:
                arrays.append(pa.array(columns.get(name, [None] * n), type_))
            return pa.RecordBatch.from_arrays(arrays, ["id", "kind", "run", *dict(FIELDS)])

        def spill() -> Iterator[pa.RecordBatch]:
            parts, docs_of, steps, times = current.spilled()
            yield out("run", pa.nulls(1, id_type), counts=[docs_of], steps=[steps], times=[times])
            if parts:
                radix, pairs, counts = zip(*parts)
                yield out("pairs", pa.nulls(len(parts), id_type), radix=radix, pairs=pairs,
                          counts=counts)

        for batch in batches:
            id_type = batch.column(0).type
            for at in range(0, batch.num_rows, 500):
                some, rows, ids_from = batch.slice(at, 500), [], 0
                for k, text in enumerate(texts_of(some.column(1))):
                    found = both.document(text)
                    a, b, groups, links, strings = found or (0, 0, 0, (), ())
                    place = len(current.sizes)
                    n = current.add(links)
                    sha = hashlib.sha256(";".join(strings).encode()).hexdigest() if found else ""
                    rows.append((place, a, b, groups, n, sha))
                    if current.full() or k == some.num_rows - 1:
                        names = ("place", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
                        yield out("doc", some.column(0).slice(ids_from, len(rows)),
                                  **dict(zip(names, zip(*rows))))
                        ids_from, rows = k + 1, []
                    if current.full():
                        yield from spill()
                        current, number = Run(), number + 1
        if current.sizes:
            yield from spill()

    fields = ", ".join(f"{name} {SQL_TYPES[type_]}" for name, type_ in FIELDS)
    return stored(source.mapInArrow(run, f"id {kind}, kind string, run bigint, {fields}"), "spills")


FIELDS = (("place", pa.int32()), ("n_a", pa.int64()), ("n_b", pa.int64()),
          ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
          ("radix", pa.int32()), ("pairs", pa.binary()), ("counts", pa.binary()),
          ("steps", pa.binary()), ("times", pa.binary()))
SQL_TYPES = {pa.int32(): "int", pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary"}


def counted(spills: DataFrame, runs: int) -> DataFrame:
    """``radix, pairs, counts, best``: one row for each radix, merged in levels of ``FAN_IN``."""
    def merge(table: pa.Table) -> pa.Table:
        keys, totals, best = merged(list(zip(table["pairs"].to_pylist(),
                                             table["counts"].to_pylist())))
        return pa.table({"radix": table["radix"][:1], "run": table["run"][:1],
                         "pairs": [packed_rising(keys)], "counts": [packed(totals)],
                         "best": [packed(best.astype(np.int64))]})

    schema = "radix int, run bigint, pairs binary, counts binary, best binary"
    level = spills.where("kind = 'pairs'").select("radix", "run", "pairs", "counts")
    while runs > 1:
        runs = -(-runs // FAN_IN)
        part = F.pmod(F.xxhash64("run"), F.lit(runs)).alias("part")
        level = stored(level.withColumn("part", part).groupBy("radix", "part")
                       .applyInArrow(merge, schema), "merged")
    return level if "best" in level.columns else stored(
        level.groupBy("radix", "run").applyInArrow(merge, schema), "merged")


def returned(spills: DataFrame, totals: DataFrame, runs: int) -> DataFrame:
    """``run, radix, counts, best`` of the pairs of each run, streamed back from the merged ones."""
    parts = -(-runs // FAN_IN)

    def look_up(asked: pa.Table, found: pa.Table) -> pa.Table:
        keys, counts, best = (unpack(found[name][0].as_py()) for name, unpack in (
            ("pairs", unpacked_rising), ("counts", unpacked), ("best", unpacked)))
        out = []
        for pairs in asked["pairs"]:
            at = np.searchsorted(keys, unpacked_rising(pairs.as_py()))
            out.append((packed(counts[at]), packed(best[at])))
        return pa.table({"run": asked["run"], "radix": asked["radix"],
                         "total": pa.array([c for c, _ in out], pa.binary()),
                         "best": pa.array([b for _, b in out], pa.binary())})

    part = F.pmod(F.xxhash64("run"), F.lit(parts)).cast("int").alias("part")
    asked = spills.where("kind = 'pairs'").select("run", "radix", "pairs", part)
    # A radix of the merged table is sent once to each part of the runs.
    found = totals.select("radix", "pairs", "counts", "best",
                          F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    return asked.groupBy("radix", "part").cogroup(found.groupBy("radix", "part")).applyInArrow(
        look_up, "run bigint, radix int, total binary, best binary")


def summed(table: pa.Table) -> pa.Table:
    """The documents of a run with what its pairs add to them."""
    kind = np.array(table["kind"].to_pylist())
    docs = table.filter(pa.array(kind == "doc"))
    (spill,) = table.filter(pa.array(kind == "run")).to_pylist()
    back = sorted(table.filter(pa.array(kind == "back")).select(
        ["radix", "total", "best"]).to_pylist(), key=lambda row: row["radix"])
    place = docs["place"].to_numpy()
    count_sum = n_best = np.zeros(len(place), dtype=np.int64)
    if back:
        total = np.concatenate([unpacked(row["total"]) for row in back])
        best = np.concatenate([unpacked(row["best"]) for row in back])
        of_pair = unpacked(spill["counts"])
        doc = np.cumsum(unpacked(spill["steps"])) % len(place)
        times = unpacked(spill["times"])
        pair = np.repeat(np.arange(len(of_pair)), of_pair)
        count_sum, n_best = np.zeros((2, len(place)), dtype=np.int64)
        np.add.at(count_sum, doc, times * total[pair])
        np.add.at(n_best, doc, times * best[pair])
    return pa.table([docs["id"], *(docs[name] for name in ("n_a", "n_b", "n_groups", "n_links")),
                     pa.array(n_best[place]), pa.array(count_sum[place]), docs["groups_sha256"]],
                    ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                     "groups_sha256"])


def align_tokenizers(docs: DataFrame, json_path: str, ranks_path: str, pattern: str,
                     model_path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose
    pair is in as many documents as any of its A id), ``count_sum`` (documents of the pair, over all
    links) and ``groups_sha256``."""
    spills = collected(docs, (json_path, ranks_path, pattern, model_path), id_col, text_col)
    runs = spills.where("kind = 'run'").count()
    back = returned(spills, counted(spills, runs), max(runs, 1))
    own = spills.where("kind <> 'pairs'").drop("radix", "pairs")
    blank = [F.lit(None).cast(own.schema[name].dataType).alias(name) for name in own.columns
             if name not in ("run", "kind")]
    both = own.select("*", F.lit(None).cast("int").alias("radix"),
                      *(F.lit(None).cast("binary").alias(name) for name in ("total", "best"))
                      ).unionByName(back.select("run", F.lit("back").alias("kind"), "radix", "total",
                                                "best", *blank))
    kind = spills.schema["id"].dataType.simpleString()
    return both.groupBy("run").applyInArrow(
        summed, f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                "n_best bigint, count_sum bigint, groups_sha256 string") \
        .withColumnRenamed("id", id_col)


def pair_counts(docs: DataFrame, json_path: str, ranks_path: str, pattern: str, model_path: str,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``a, b, documents, best``: for each linked pair of ids how many documents hold it, and whether
    that is the most of its A id."""
    spills = collected(docs, (json_path, ranks_path, pattern, model_path), id_col, text_col)
    back = pow(SPREAD, -1, 1 << HIGH_BITS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                key = unpacked_rising(row["pairs"])
                yield pa.record_batch({
                    "a": ((key >> LOW_BITS) * back & 0xFFFF).astype(np.int32),
                    "b": (key & ((1 << LOW_BITS) - 1)).astype(np.int32),
                    "documents": unpacked(row["counts"]), "best": unpacked(row["best"]) > 0})

    found = counted(spills, spills.where("kind = 'run'").count())
    return found.select("pairs", "counts", "best").mapInArrow(
        rows, "a int, b int, documents bigint, best boolean")
