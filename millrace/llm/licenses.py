"""License scans with a positional index of rare words.

Each template is a run of words with phrases in it that must be there.  The index holds, for the
rarest words of each template, at which position of which template they stand; how rare a word is
comes from the number of documents that have it.  A document looks up its own words in the index,
highest IDF first; a word at place p that stands at position q of a template says that the template
may start at p - q.

Base phrases must stand there whole.  Of a notice a share of the words is enough: as many words may
be missing as the share leaves, and each word may lie up to so many places off where the start puts
it, so words may also be put in.  A notice is looked up by one more of its words than may be
missing, so that one of them is always there.  The postings of its words are intersected by their
places relative to the start, in order: the longest sequence of template words that the document
has in the same order is what counts, and all mandatory phrases must be whole within it.  Places of
one notice do not overlap; of those that do, the one found through the rarest word counts, then the
first.

Null and empty texts have no words and no labels.  Overlapping places of base phrases all count.
Rows are judged one by one, so repeated rows and ids give repeated results.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import column, map_batches, texts_of

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

@dataclass(frozen=True)
class Template:
    """A phrase or notice.  ``base`` templates must be there whole, the others to ``share``."""

    label: str
    text: str
    required: tuple[str, ...] = ()
    base: bool = False
    share: float = 0.7


# The base phrases and their labels.
BASE = (
    Template("cc-by", "cc by", base=True),
    Template("gpl", "general public license", base=True),
    Template("reserved", "all rights reserved", base=True),
)

# Paragraphs of public licence notices, and phrases that name licences.
NOTICES = (
    Template("mit", "mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of "
                    "this software and associated documentation files",
             ("permission is hereby granted", "free of charge")),
    Template("mit", "to deal in the software without restriction including without limitation the "
                    "rights to use copy modify merge publish distribute sublicense and or sell "
                    "copies of the software and to permit persons to whom the software is furnished "
                    "to do so subject to the following conditions", ("without restriction",)),
    Template("mit", "the above copyright notice and this permission notice shall be included in all "
                    "copies or substantial portions of the software", ("permission notice",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose "
                    "with or without fee is hereby granted provided that the above copyright notice "
                    "and this permission notice appear in all copies",
             ("with or without fee", "is hereby granted")),
    Template("apache-2.0", "apache license version 2 0", ("apache license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0 the license you may not "
                           "use this file except in compliance with the license you may obtain a "
                           "copy of the license at", ("apache license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without "
                    "modification are permitted provided that the following conditions are met",
             ("source and binary forms",)),
    Template("bsd", "redistributions of source code must retain the above copyright notice this "
                    "list of conditions and the following disclaimer", ("list of conditions",)),
    Template("bsd", "redistributions in binary form must reproduce the above copyright notice this "
                    "list of conditions and the following disclaimer in the documentation and or "
                    "other materials provided with the distribution", ("binary form",)),
    Template("bsd", "bsd license", ("bsd license",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under "
                    "the terms of the gnu general public license",
             ("free software", "redistribute it")),
    Template("gpl", "you should have received a copy of the gnu general public license along with "
                    "this program if not see", ("gnu general public license",)),
    Template("gpl", "gnu gpl", ("gnu gpl",)),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("lgpl", "this library is free software you can redistribute it and or modify it under "
                     "the terms of the gnu lesser general public license as published by the free "
                     "software foundation", ("lesser general public license",)),
    Template("mpl-2.0", "mozilla public license", ("mozilla public license",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public "
                        "license v 2 0 if a copy of the mpl was not distributed with this file you "
                        "can obtain one at", ("source code form",)),
    Template("zlib", "permission is granted to anyone to use this software for any purpose "
                     "including commercial applications and to alter it and redistribute it freely "
                     "subject to the following restrictions", ("redistribute it freely",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain "
                          "anyone is free to copy modify publish use compile sell or distribute "
                          "this software", ("unencumbered software",)),
    Template("cc-by", "creative commons attribution", ("creative commons attribution",)),
    Template("cc-by-nc", "cc by nc", ("cc by nc",)),
    Template("cc-by-sa", "cc by sa", ("cc by sa",)),
    Template("cc-by-nd", "cc by nd", ("cc by nd",)),
    Template("cc0", "cc0 1 0 universal", ("cc0",)),
    Template("public-domain", "dedicated to the public domain", ("public domain",)),
)


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words of ASCII letters, digits and all characters beyond ASCII."""
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def missing(template: Template, length: int) -> int:
    """How many of a template's ``length`` words may be missing."""
    return 0 if template.base else length - math.ceil(template.share * length - 1e-9)


class PhraseIndex:
    """Postings of the templates' rarest words; ``frequency`` is documents by word."""

    def __init__(self, templates: Iterable[Template], frequency: dict[bytes, int], documents: int):
        self.templates = [(t, words_of(t.text), [words_of(r) for r in t.required or (t.text,)])
                          for t in templates]
        self.idf: dict[bytes, float] = {}
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for i, (template, words, required) in enumerate(self.templates):
            if not words or not all(required):
                raise ValueError(f"{template.label}: a template and its phrases need words")
            for word in words:
                self.idf[word] = math.log((documents + 1) / (frequency.get(word, 0) + 1))
            rare = sorted(set(words), key=lambda w: (-self.idf[w], w))
            for word in rare[:missing(template, len(words)) + 1]:
                self.postings.setdefault(word, []).extend(
                    (i, at) for at, w in enumerate(words) if w == word)

    def find(self, words: list[bytes]) -> list[tuple[int, int, int, float]]:
        """(template, place of its first word, number of words from there to its last, share of the
        template found), ordered."""
        at: dict[bytes, list[int]] = {}
        for place in [i for i, w in enumerate(words) if w in self.idf]:
            at.setdefault(words[place], []).append(place)
        looked_up = sorted(at.keys() & self.postings.keys(), key=lambda w: (-self.idf[w], w))
        fits = {i for i in {i for word in looked_up for i, _ in self.postings[word]}
                if sum(w in at for w in self.templates[i][1]) >= self._enough(i)}
        seen, found, spans = set(), [], {}
        for word in looked_up:
            for i, position in self.postings[word]:
                if i not in fits:
                    continue
                for place in at[word]:
                    start = place - position
                    if (i, start) in seen:
                        continue
                    seen.add((i, start))
                    match = self._match(words, at, i, start)
                    if match and self.templates[i][0].base:
                        found.append((i, *match))
                    elif match and free(spans.setdefault(i, []), match[0], match[0] + match[1]):
                        found.append((i, *match))
        return sorted(found)

    def _enough(self, i: int) -> int:
        template, expected, _ = self.templates[i]
        return len(expected) - missing(template, len(expected))

    def _match(self, words: list[bytes], at: dict[bytes, list[int]], i: int,
               start: int) -> tuple[int, int, float] | None:
        """First place, words from there to the last, and share of template ``i`` at ``start``."""
        template, expected, required = self.templates[i]
        if template.base:
            whole = start >= 0 and words[start:start + len(expected)] == expected
            return (start, len(expected), 1.0) if whole else None
        slack = missing(template, len(expected))
        # The postings of each word near its place; the last word of the shortest-reaching sequence
        # of each length, with the pair before it.
        ends: list[int] = []
        last: list[tuple] = []
        near = 0
        for k, word in enumerate(expected):
            places = at.get(word, ())
            low = bisect_left(places, start + k - slack)
            high = bisect_right(places, start + k + slack)
            near += low < high
            if k - near >= slack:
                return None
            for place in reversed(places[low:high]):
                length = bisect_left(ends, place)
                pair = (place, last[length - 1] if length else None)
                if length == len(ends):
                    ends.append(place)
                    last.append(pair)
                else:
                    ends[length], last[length] = place, pair
        if len(ends) < self._enough(i):
            return None
        first = last[-1]
        while first[1]:
            first = first[1]
        span = words[first[0]:ends[-1] + 1]
        if not all(contains(span, phrase) for phrase in required):
            return None
        return first[0], len(span), len(ends) / len(expected)


def free(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether a span meets none of ``spans``, which are in order; it is added then."""
    at = bisect_left(spans, (start, end))
    if at and spans[at - 1][1] > start or at < len(spans) and spans[at][0] < end:
        return False
    spans.insert(at, (start, end))
    return True


def contains(words: list[bytes], phrase: list[bytes]) -> bool:
    return any(words[k:k + len(phrase)] == phrase for k in range(len(words) - len(phrase) + 1))


def document_frequency(docs: DataFrame, templates: Iterable[Template],
                       text_col: str = "text") -> tuple[dict[bytes, int], int]:
    """In how many of all documents each word of the templates is, and the number of documents."""
    vocabulary = {w for t in templates for w in words_of(t.text)}

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: dict[bytes, int] = {b"": batch.num_rows}
        for text in texts_of(batch.column(0)):
            for word in vocabulary.intersection(words_of(text)):
                counts[word] = counts.get(word, 0) + 1
        return pa.record_batch({"word": pa.array(counts, pa.binary()),
                                "n": pa.array(counts.values(), pa.int64())})

    partial = map_batches(docs.select(column(text_col).alias("text")), count,
                          "word binary, n bigint")
    # One row for each word of the templates.
    found = {bytes(r.word): r.n for r in partial.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return found, found.pop(b"", 0)


def license_scan(docs: DataFrame, templates: Iterable[Template] = BASE + NOTICES,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_words`` and ``matches``.

    A match has the template's label, whether it is a base phrase, the first word's place, the
    number of words up to its last and the share of the template that is there.
    """
    templates = tuple(templates)
    index = PhraseIndex(templates, *document_frequency(docs, templates, text_col))
    source = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    match = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()),
                       ("length", pa.int64()), ("share", pa.float64())])

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, matches = [], []
        for text in texts_of(batch.column(1)):
            words = words_of(text)
            counts.append(len(words))
            matches.append([
                {"label": index.templates[i][0].label, "base": index.templates[i][0].base,
                 "start": start, "length": length, "share": share}
                for i, start, length, share in index.find(words)])
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(matches, pa.list_(match))],
            ["id", "n_words", "matches"])

    schema = (f"id {kind}, n_words bigint, matches array<struct<label:string, base:boolean, "
              "start:bigint, length:bigint, share:double>>")
    return map_batches(source, scan, schema).withColumnRenamed("id", id_col)


def license_summary(scans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, places, labels and score of :func:`license_scan`'s matches."""
    base = F.filter("matches", lambda m: m["base"])

    def labels(matches):
        return F.array_join(F.array_sort(F.array_distinct(
            F.transform(matches, lambda m: m["label"]))), ",")

    starts = F.transform(base, lambda m: m["start"])
    return scans.select(
        column(id_col), "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0))
        .alias("score"),
    )
