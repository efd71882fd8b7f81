"""Encoding and decoding with a merge-type piece model, by a table over prefixes.

A merge-type encoder joins the two neighbours whose union has the best score until none are left.
Its result has two properties: every run of tokens in it is itself the encoding of its characters,
and a token sequence is an encoding as soon as each two neighbours are.  So every prefix of a text
has one last token, and it is the one token that ends there, fits the last token of the prefix
before it, and is itself reachable.  The table is filled from left to right with the matches of an
automaton over all tokens; the ids are then read off from the end.

Merges never cross a space that follows another character, because no piece has one inside, so a
text is encoded word by word and words are remembered.  Null and empty texts have no ids.  Runs of
spaces, whose pieces share one score, and the few pieces whose parts have worse scores than they
have themselves, are merged step by step.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .batches import column, map_batches, texts_of

SPACE = "▁"
#: A worker remembers between one and two times so many words.
REMEMBERED = 200_000
#: Longer words are encoded each time.
LONGEST_REMEMBERED = 200
# The piece types of the model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def read_model(path: str) -> list[tuple[str, float, int]]:
    """Piece, score and type of each id."""
    from sentencepiece import sentencepiece_model_pb2 as schema

    model = schema.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules, kind = model.normalizer_spec, model.trainer_spec
    plain = (kind.model_type == kind.BPE and not rules.precompiled_charsmap
             and rules.add_dummy_prefix and not rules.remove_extra_whitespaces
             and rules.escape_whitespaces and kind.byte_fallback
             and not kind.treat_whitespace_as_suffix)
    if not plain or any(p.type in (USER, UNUSED) for p in model.pieces):
        raise ValueError("only merge-type models with bytes, without text rules or own symbols")
    return [(p.piece, p.score, p.type) for p in model.pieces]


class PieceCodec:
    """Encodes and decodes; ``pieces`` as from :func:`read_model`."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        self.text = [piece for piece, _, _ in pieces]
        self.type = [kind for _, _, kind in pieces]
        self.id = {piece: i for i, (piece, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.rank = {piece: -score for piece, score, kind in pieces if kind == NORMAL}
        self.byte = {int(piece[1:-1], 16): i
                     for i, (piece, _, kind) in enumerate(pieces) if kind == BYTE}
        self.known = {piece for piece in self.id if len(piece) == 1}
        self.parts: dict[str, tuple[str, str]] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        inner = {p for p in self.id if SPACE in p[1:]}
        if any(p.strip(SPACE) for p in inner):
            raise ValueError("pieces with a space inside are not supported")
        self.automaton = ahocorasick.Automaton()
        self.irregular = ahocorasick.Automaton()
        for piece in self.id:
            if piece in inner:
                continue
            made = self.merge(piece, self.parts) if len(piece) > 1 else [piece]
            if made == [piece]:
                self.automaton.add_word(piece, (len(piece), piece))
            if len(piece) > 1 and not self._regular(piece, made):
                self.irregular.add_word(piece, piece)
        for automaton in (self.automaton, self.irregular):
            automaton.make_automaton()
        self.any_irregular = len(self.irregular) > 0
        self.digits = [str(i) for i in range(len(pieces))]
        self.adjacent = {piece[i:i + 2] for piece in self.id for i in range(len(piece) - 1)}
        chars = "".join(map(re.escape, sorted(self.known)))
        self.runs = re.compile(f"([{chars}]+)|([^{chars}])", re.DOTALL)
        self.words: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}

    def _regular(self, piece: str, made: list[str]) -> bool:
        """Made from parts with better scores, or not reachable at all."""
        if made != [piece]:
            return True
        return all(len(part) == 1 or self.rank[part] < self.rank[piece]
                   for part in self.parts[piece])

    def merge(self, text: str, parts: dict | None = None) -> list[str]:
        """The encoding by merging step by step; ``parts`` gets what a piece is last made of."""
        left, right = list(range(-1, len(text) - 1)), list(range(1, len(text) + 1))
        symbol: list[str] = list(text)
        heap: list[tuple[float, int, int]] = []

        def offer(i: int) -> None:
            j = right[i] if i >= 0 else len(text)
            if i >= 0 and j < len(text):
                rank = self.rank.get(symbol[i] + symbol[j])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, len(symbol[i]) + len(symbol[j])))

        for i in range(len(text)):
            offer(i)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = right[i]
            if not symbol[i] or j >= len(text) or len(symbol[i]) + len(symbol[j]) != size:
                continue
            joined = symbol[i] + symbol[j]
            if parts is not None and joined == text:
                parts[text] = (symbol[i], symbol[j])
            symbol[i], symbol[j], right[i] = joined, "", right[j]
            if right[j] < len(text):
                left[right[j]] = i
            offer(left[i])
            offer(i)
        return [s for s in symbol if s]

    def compatible(self, first: str, second: str) -> bool:
        """Whether the encoding of ``first + second`` is these two tokens.

        Going back in the order of merges, the tokens that touch the border change one by one.  The
        border breaks if their union is a piece that would be made before the next change.
        """
        rank, never = self.rank, float("inf")
        a, b, end_a, end_b = first, second, never, never
        while True:
            joined = rank.get(a + b)
            # Equal scores: the merge further left comes first.
            if joined is not None and joined < end_a and joined <= end_b:
                return False
            made_a = rank[a] if len(a) > 1 else -1.0
            made_b = rank[b] if len(b) > 1 else -1.0
            if made_a < 0 and made_b < 0:
                return True
            if made_a >= made_b:
                a, end_a = self.parts[a][1], made_a
            else:
                b, end_b = self.parts[b][0], made_b

    def _table(self, text: str) -> list[str]:
        """The tokens of known characters, by the last token of each prefix."""
        fits = self.fits
        last: list[str] = [""] * (len(text) + 1)
        for end, (size, piece) in self.automaton.iter(text):
            end += 1
            if last[end]:
                continue
            if size < end:
                before = last[end - size]
                if not before:
                    continue
                pair = before, piece
                fit = fits.get(pair)
                if fit is None:
                    fit = fits[pair] = self.compatible(before, piece)
                if not fit:
                    continue
            last[end] = piece
        tokens, at = [], len(text)
        while at:
            token = last[at]
            tokens.append(token)
            at -= len(token)
        tokens.reverse()
        return tokens

    def _known(self, run: str) -> list[str]:
        by_step = SPACE in run[1:] or self.any_irregular and any(
            True for _ in self.irregular.iter(run))
        return self.merge(run) if by_step else self._table(run)

    def _word(self, word: str) -> list[int]:
        """Ids of a word; unknown characters part it and become bytes."""
        ids: list[int] = []
        for run, char in self.runs.findall(word):
            if run:
                ids += map(self.id.__getitem__, self._known(run))
            else:
                ids += map(self.byte.__getitem__, char.encode("utf-8", "surrogatepass"))
        return ids

    def split(self, text: str) -> list[str]:
        """The words of a text, each with the spaces before it as the model writes them."""
        if not text:
            return []
        if SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            return [SPACE + word for word in text.split(" ")]
        return re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE))

    def remember(self, word: str) -> tuple[str, str]:
        """The ids of a word as text, and the text that they decode to."""
        found = self.older.get(word)
        if found is None:
            # Where no piece has two characters in a row, no token goes over them.
            cuts = [i for i in range(1, len(word))
                    if word[i - 1:i + 1] not in self.adjacent and word[i - 1] != SPACE]
            if cuts:
                parts = [self.words.get(part) or self.remember(part) for part in
                         (word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)]))]
                found = ",".join([ids for ids, _ in parts]), "".join([text for _, text in parts])
            else:
                numbers = self._word(word)
                found = ",".join(map(self.digits.__getitem__, numbers)), self.pieces_text(numbers)
        # Long runs seldom come again, and their parts are remembered.
        if len(word) <= LONGEST_REMEMBERED:
            if len(self.words) >= REMEMBERED:
                self.older, self.words = self.words, {}
            self.words[word] = found
        return found

    def encode(self, text: str | None) -> list[int]:
        return [i for word in self.split(text or "") for i in self._word(word)]

    def pieces_text(self, ids: list[int]) -> str:
        """The text of ids, with the space that the model puts first."""
        out, raw = [], bytearray()
        for i in ids:
            if self.type[i] == BYTE:
                raw.append(int(self.text[i][1:-1], 16))
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if self.type[i] == NORMAL:
                out.append(self.text[i])
            elif self.type[i] == UNKNOWN:
                out.append(f" ⁇ ")
        out.append(raw.decode("utf-8", "replace"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        return without_first_space(self.pieces_text(ids))

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, sha256 of the ids and of the decoded text."""
        found = [self.words.get(word) or self.remember(word) for word in self.split(text or "")]
        ids = ",".join([ids for ids, _ in found])
        decoded = without_first_space("".join([text for _, text in found]))
        return (ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(),
                hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())


def without_first_space(text: str) -> str:
    return text[text.startswith(SPACE):].replace(SPACE, " ")


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    """One codec per worker and model; the file is part of the installed vocabulary."""
    return PieceCodec(read_model(path))


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: ``id``, its ``ids`` and the text ``decoded`` from them."""
    source = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(model)
        ids = [own.encode(text) for text in texts_of(batch.column(1))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(ids, pa.list_(pa.int32())),
             pa.array([own.decode(i) for i in ids], pa.string())], ["id", "ids", "decoded"])

    return map_batches(source, encode, f"id {kind}, ids array<int>, decoded string") \
        .withColumnRenamed("id", id_col)


def piece_digests(docs: DataFrame, model: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Like :func:`encode_pieces` with sums in the place of ids and text, word by word."""
    source = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(model)
        found = [own.digest(text) for text in texts_of(batch.column(1))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([f[0] for f in found], pa.int64()),
             pa.array([f[1] for f in found]), pa.array([f[2] for f in found])],
            ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(source, encode, f"id {kind}, n_tokens bigint, ids_sha256 string, "
                                       "decoded_sha256 string").withColumnRenamed("id", id_col)
