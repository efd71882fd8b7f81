"""Nearest vectors, aligned tokenizers and runs, against plain computations and on edge rows."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import public_tokenizers as vocabularies
from millrace.llm import alignment, embeddings, neighbours, packing, runs, toxicity, wrappers
from millrace.llm.queries import QUERIES, with_repeats

SF = "/root/testdata/sf0.001"
PATHS = (vocabularies.path("byte_bpe_50k.json"), vocabularies.path("byte_bpe_50k.tiktoken"),
         vocabularies.PATTERN, vocabularies.path("piece_bpe_32k.model"))
TEXTS = [None, "", " ", "\n", "a", "Éé ß", "a  b", " lead", "trail ", "▁▁x", "a ▁ b", "<s> <0x41>",
         "日本語 テスト", "😀 ok", "\x00\x01", "word " * 3000, "don't 'll", "a \n b", "½ Ⅷ", "a\n  b",
         "<|endoftext|> in text", "x  y", "a\x1c b", "   z", "tab\t tab", "   ", "12345 678"]


def edge_table(spark, texts=TEXTS):
    """Edge texts with repeated rows, null ids and columns named like results."""
    rows = [(i, t, "x", 0.5) for i, t in enumerate(texts)] + [(0, None, "x", 0.5), (4, "a", "y", 1.0),
                                                              (None, "a b c", "z", 0.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, n_links double")


# --- nearest vectors ---

def vector_table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1) for i, v in rows],
                                 "vec_id long, embedding array<float>, label int, rank int")


def nearest(rows, query, k=10):
    """(distance, id) by brute force over (id, vector)."""
    i, v = query
    best = {}
    for j, w in rows:
        if j != i:
            n = max(len(v), len(w))
            x, y = (np.array([*map(np.float32, u), *[0] * (n - len(u))], dtype=np.float64)
                    for u in (v, w))
            best[j] = min(best.get(j, np.inf), float(np.sqrt(((x - y) ** 2).sum())))
    return sorted((d, j) for j, d in best.items())[:k]


def test_neighbours_recall_at_scale(spark):
    sf = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    ids, vectors = table["vec_id"].to_numpy(), np.array(table["embedding"].tolist(), dtype=float)
    found = {}
    for r in QUERIES["op11_neighbours"](spark, sf).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(found) == sorted(i for i in ids if i % 100 == 0)
    hits = 0
    for i, rows in found.items():
        far = np.sqrt(((vectors - vectors[ids == i]) ** 2).sum(axis=1))
        order = [k for k in np.lexsort((ids, far)) if ids[k] != i][:10]
        hits += len({ids[k] for k in order} & {j for _, j, _ in rows})
        assert [r for r, _, _ in sorted(rows)] == list(range(1, 11))
        for _, j, score in rows:
            assert np.isclose(score, far[ids == j][0], rtol=1e-14)
        assert [(s, j) for _, j, s in sorted(rows)] == sorted((s, j) for _, j, s in rows)
    assert hits >= 0.95 * 10 * len(found)


def test_neighbours_on_copies_and_edge_vectors(spark, monkeypatch):
    """Large groups of copies, ties, repeated rows and ids, odd vectors; full recall asked for."""
    monkeypatch.setattr(neighbours, "BLOCK", 50)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(1, 420)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)] + [(2000, rows[0][1]), (2000, rows[5][1])]
    rows += rows[:30] + [(2100, [1.0, 2.0]), (2101, [1.0, 2.0, 0.0]), (2200, [1e30] * 8)]
    odd = [(3000, None), (3100, []), (3200, [0.0] * 8), (3300, [float("nan")] * 8),
           (3400, [float("inf")] + [0.0] * 7), (3500, [None] + [1.0] * 7), (None, [1.0] * 8)]
    found = {}
    for r in neighbours.nearest_vectors(vector_table(spark, rows + odd), recall=1.0).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    queries = {i for i, _ in rows if i % 100 == 0}
    assert set(found) == queries and 2000 in queries and 2200 in queries
    for i in queries - {2000}:
        want = nearest(rows, next(r for r in rows if r[0] == i))
        got = sorted(found[i])
        assert [j for _, _, j in got] == [j for _, j in want], i
        assert np.allclose([s for _, s, _ in got], [d for d, _ in want], rtol=1e-12)
    # An id with two vectors asks with each.
    assert Counter(r for r, _, _ in found[2000]) == {r: 2 for r in range(1, 11)}
    assert [j for r, s, j in sorted(found[2000]) if s == 0][0] == 1


def test_all_candidates_of_small_tables(spark):
    few = [(100, [1.0, 0.0]), (7, [0.0, 1.0]), (8, [0.0, 1.0]), (200, [5.0, 5.0])]
    found = neighbours.nearest_vectors(vector_table(spark, few)).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in found] == [
        (100, 1, 7), (100, 2, 8), (100, 3, 200), (200, 1, 7), (200, 2, 8), (200, 3, 100)]
    for rows in ([], [(100, [1.0, 2.0])], [(1, [1.0]), (2, [2.0])], [(None, None)]):
        assert neighbours.nearest_vectors(vector_table(spark, rows)).count() == 0
    text = spark.createDataFrame([("100", [1.0, 2.0]), ("x", [1.0, 2.0]), ("5", [1.0, 3.0])],
                                 "vec_id string, embedding array<double>")
    assert [(r.query_id, r.vec_id, r.score) for r in neighbours.nearest_vectors(text).collect()] == [
        (100, 5, 1.0)]


def test_queries_without_enough_within_the_radius(spark):
    """With no share to take in, the radius is small and the rest is compared with all rows."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=16)]) for i in range(0, 900)]
    found = neighbours.nearest_vectors(vector_table(spark, rows), recall=0.0).collect()
    assert Counter(r.query_id for r in found) == {i: 10 for i in range(0, 900, 100)}


def test_footrule_of_inverted_files():
    rng = np.random.default_rng(1)
    codes = np.argsort(rng.random((60, 40)), axis=1)[:, :12].astype(np.uint8)
    files = neighbours.InvertedFiles.of(codes)

    def plain(a, b):
        a, b = ({p: k for k, p in enumerate(x.tolist())} for x in (a, b))
        return sum(abs(a.get(p, 12) - b.get(p, 12)) for p in {*a, *b})

    for q in codes[:10]:
        assert files.footrule(q).tolist() == [plain(q, x) for x in codes]


# --- aligned tokenizers ---

def plain_alignment(texts):
    """Tokens, groups and links of whole texts by the libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATHS[0])
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=PATHS[3])
    letters = alignment.byte_letters()
    out = []
    for text in texts:
        if not text:
            out.append(None)
            continue
        whole = (" " + text).encode()
        a, b = library.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
        ab = [bytes(letters[c] for c in library.id_to_token(i)) for i in a]
        bb = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i)
              else pieces.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(ab) != whole or b"".join(bb) != whole:
            out.append(None)
            continue
        ae, be = np.cumsum([*map(len, ab)]).tolist(), np.cumsum([*map(len, bb)]).tolist()
        links = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b))
                 if max(ae[i] - len(ab[i]), be[j] - len(bb[j])) < min(ae[i], be[j])] \
            if len(a) * len(b) < 10 ** 6 else walked(a, ae, b, be)
        groups, i, j = [], 0, 0
        for end in sorted({*ae} & {*be}):
            x, y = ae.index(end, i) + 1, be.index(end, j) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            i, j = x, y
        out.append((len(a), len(b), groups, links))
    return out


def walked(a, ae, b, be):
    """Links of long texts: for each token of A the tokens of B from the first that ends later."""
    links = []
    for i, end in enumerate(ae):
        start = ae[i - 1] if i else 0
        j = int(np.searchsorted(be, start, "right"))
        while j < len(be) and (be[j - 1] if j else 0) < end:
            links.append((a[i], b[j]))
            j += 1
    return links


def compare_alignment(spark, docs, texts):
    plain = plain_alignment(texts)
    counts = Counter(pair for row in plain if row for pair in set(row[3]))
    top = {}
    for (a, _), n in counts.items():
        top[a] = max(top.get(a, 0), n)
    want = []
    for row in plain:
        if row is None:
            want.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = row
        want.append((a, b, len(groups), len(links), sum(counts[p] == top[p[0]] for p in links),
                     sum(counts[p] for p in links),
                     hashlib.sha256(";".join(groups).encode()).hexdigest()))
    found = alignment.align_tokenizers(docs, *PATHS).collect()
    assert len(found) == len(texts)
    assert sorted(tuple(r)[1:] for r in found) == sorted(want)
    return found, counts, top


@pytest.mark.parametrize("limits", [(4_000_000, 50_000, 256), (2_000, 7, 2)])
def test_alignment_equals_plain_computation(spark, monkeypatch, limits):
    """Small limits make many runs, which are merged in several levels."""
    for name, value in zip(("RUN_LINKS", "RUN_DOCS", "FAN_IN"), limits):
        monkeypatch.setattr(alignment, name, value)
    random.seed(9)
    soup = ["".join(random.choices("abcdeéèßth .,\n\t▁ 0123日😀ing  ", k=random.randint(1, 60)))
            for _ in range(60)]
    real = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()][:80]
    texts = TEXTS + soup + real
    docs = edge_table(spark, texts)
    found, counts, top = compare_alignment(spark, docs.repartition(3), texts + [None, "a", "a b c"])
    own = {r.doc_id: r for r in found}
    assert own[1].groups_sha256 == "" and own[9].n_links == own[10].n_links == 0
    pairs = alignment.pair_counts(docs.repartition(3), *PATHS).collect()
    assert {(r.a, r.b): r.documents for r in pairs} == counts
    assert all(r.best == (r.documents == top[r.a]) for r in pairs)


def test_alignment_edge_tables(spark):
    schema = "doc_id string, text string"
    assert alignment.align_tokenizers(spark.createDataFrame([], schema), *PATHS).count() == 0
    assert alignment.pair_counts(spark.createDataFrame([], schema), *PATHS).count() == 0
    nulls = spark.createDataFrame([(None, None), ("x", ""), ("x", "")], schema)
    assert [r.n_links for r in alignment.align_tokenizers(nulls, *PATHS).collect()] == [0, 0, 0]
    long = "x" * 50_000 + " 한국어" * 10_000
    found = alignment.align_tokenizers(spark.createDataFrame([("a", long)] * 40, schema), *PATHS)
    assert {r.count_sum == 40 * r.n_links > 0 for r in found.collect()} == {True}


def test_packed_numbers():
    for numbers in ([], [0], [255], [256, 0], [2 ** 40, 1], [65_536]):
        array = np.array(numbers, dtype=np.int64)
        assert alignment.unpacked(alignment.packed(array)).tolist() == numbers
        rising = np.cumsum(array)
        assert alignment.unpacked_rising(alignment.packed_rising(rising)).tolist() == rising.tolist()


# --- runs ---

def plain_runs(words):
    """All runs, period by period."""
    found, n = [], len(words)
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            end = i + p
            stretch = words[start:end]
            if end - start >= max(6, 4 * p) and not any(
                    p % q == 0 and stretch[q:] == stretch[:-q] for q in range(1, p)):
                found.append((start, end - start, p))
    return sorted(found)


def plain_dropped(found, n):
    return [any(s + p <= i < s + length for s, length, p in found) for i in range(n)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40),
       st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 9)),
                max_size=12), st.booleans())
def test_runs_equal_plain_search(random_words, parts, doubled):
    words = random_words + [w for unit, times in parts for w in unit * times]
    words += words if doubled else []
    found = runs.runs_of(words)
    assert found == plain_runs(words)
    assert runs.dropped(found, len(words)).tolist() == plain_dropped(found, len(words))


def test_runs_of_special_words():
    thue = [bin(i).count("1") % 2 for i in range(4096)]
    assert runs.runs_of(thue) == []
    x, y = [1], [1, 2]
    while len(y) < 5000:
        x, y = y, y + x
    assert runs.runs_of(y) == []
    assert runs.runs_of([7] * 300_000) == [(0, 300_000, 1)]
    assert runs.runs_of([7] * 5) == [] and runs.runs_of([7] * 6) == [(0, 6, 1)]
    unit = list(range(30_000))
    assert runs.runs_of([-1, *unit * 4, 5]) == [(1, 120_000, 30_000)]
    mixed = ([1] * 50 + [2]) * 40
    assert runs.runs_of(mixed) == plain_runs(mixed)


def test_run_queries_equal_plain_computation(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    edge = spark.createDataFrame(
        [(900_000 + i, t) for i, t in enumerate(TEXTS + ["a b " * 400, "x\x0by\x1cz \x85 w" * 9])],
        "doc_id long, text string")
    both = docs.unionByName(edge)
    found = {r.doc_id: r for r in runs.periodic_runs(
        both.withColumn("text", with_repeats(F.col("text"), F.col("doc_id")))).collect()}
    several = 0
    for r in both.collect():
        words = (r.text or "").encode().split()
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        own = found[r.doc_id]
        want = plain_runs(words) if n < 3000 else runs.runs_of(words)
        assert [tuple(x) for x in own.runs] == want
        best = max(want, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        assert (own.best and tuple(own.best)) == best
        out = plain_dropped(want, n) if n < 3000 else runs.dropped(want, n).tolist()
        assert own.collapsed == b" ".join(w for w, o in zip(words, out) if not o).decode()
        several += len(want) > 0
    assert several > 5
    if docs.count() == QUERIES["op13_runs"](spark, SF).count():
        for r in QUERIES["op13_runs"](spark, SF).collect():
            own = found[r.doc_id]
            lines = "".join(f"{s},{n},{p}\n" for s, n, p in own.runs)
            assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
            assert r.collapsed_sha256 == hashlib.sha256(own.collapsed.encode()).hexdigest()
            assert r.n_runs == len(own.runs)
            assert (r.start, r.length, r.period) == (tuple(own.best) if own.best else (None,) * 3)
            assert r.exponent_milli == (1000 * own.best[1] // own.best[2] if own.best else None)


def test_runs_edge_rows(spark):
    found = runs.periodic_runs(edge_table(spark)).collect()
    assert len(found) == len(TEXTS) + 3
    assert [(r.n_words, r.collapsed) for r in found if r.doc_id == 0] == [(0, ""), (0, "")]
    (long,) = [r for r in found if r.doc_id == TEXTS.index("word " * 3000)]
    assert [tuple(x) for x in long.runs] == [(0, 3000, 1)] and long.collapsed == "word"
    assert runs.periodic_runs(edge_table(spark).where("false")).count() == 0


# --- toxicity ---

def plain_stretches(values, words, size):
    """Means over the different words of each window, window by window."""
    n, half = len(words), (size or 2) // 2
    starts = [0] if size is None or size >= n else range(0, n - half, half)
    out = []
    for start in starts:
        window = words[start:] if size is None else words[start:start + size]
        distinct = {w: values[start + k] for k, w in reversed([*enumerate(window)])}
        out.append(sum(distinct.values()) / max(len(distinct), toxicity.LEAST))
    return out


@pytest.mark.parametrize("size", [None, 2, 8, 128])
def test_stretches_equal_plain_windows(size):
    rng = random.Random(5)
    for _ in range(60):
        words = [f"w{rng.randrange(30)}" for _ in range(rng.randrange(1, 400))]
        value = {w: rng.uniform(-1, 1) for w in words}
        values = np.array([value[w] for w in words])
        found = toxicity.stretch_means(values, toxicity.earlier(words), size)
        assert np.allclose(found, plain_stretches(values, words, size))


def test_repeated_words_of_long_texts_are_seen():
    """A passage counts although each of its words stood alone in the text before."""
    rng = random.Random(6)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "re") for b in ("ba", "do", "fi", "gu")]

    def text(n, insults):
        words = [rng.choice(vocabulary) for _ in range(n)]
        for _ in range(insults):
            words[rng.randrange(n)] = rng.choice(["idiot", "moron", "scum"])
        return " ".join(words)

    texts = [text(150, 0) for _ in range(150)] + [text(150, 8) for _ in range(150)]
    model = toxicity.train(texts, np.array([0] * 150 + [1] * 150))
    strewn = vocabulary * 150
    for place, word in ((10, "idiot"), (900, "moron"), (1800, "scum")):
        strewn[place] = word
    passage = strewn[:2500] + ["idiot", "moron", "scum", "idiot", "pathetic", "moron"] * 8 + strewn[2500:]
    assert model.tops(" ".join(passage))[0] > 1.5 * model.tops(" ".join(strewn))[0] > 0
    assert model.score(" ".join(vocabulary * 200)) < 0.5 < model.score(text(150, 10))


def test_training_goes_far_beyond_its_start():
    """The loss over the documents, at the border that suits it best and each class weighing the
    same, falls to less than half of the start's."""
    rng = random.Random(7)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "re", "su") for b in ("ba", "do", "fi", "gu")]
    insults = ["idiot", "moron", "scum", "trash"]
    texts = [[rng.choice(words) for _ in range(120)] for _ in range(300)]
    label = np.array([0.0] * 240 + [1.0] * 60)
    for text in texts[240:]:
        for _ in range(5):
            text[rng.randrange(len(text))] = rng.choice(insults)
    vocabulary = words + insults
    grams = toxicity.Grams(vocabulary)
    docs = [np.array([vocabulary.index(w) for w in text]) for text in texts]
    begin = toxicity.first_guess(grams, docs, label)

    def loss(gram):
        odds = grams.odds(gram)
        tops = np.array([odds[np.unique(d)].sum() / toxicity.LEAST for d in docs])
        return min(np.mean([np.log1p(np.exp(-(2 * y - 1) * (tops[label == y] - border))).mean()
                            for y in (0, 1)]) for border in np.linspace(-5, 5, 201))

    # The softmax gives the start a weight of 10 in each class.
    assert loss(toxicity.fit_grams(grams, begin, docs, label, 5)) < 0.5 * loss(20 * begin)


def test_scores_equal_a_plain_computation(spark):
    docs = edge_table(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(TEXTS))], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    for r in toxicity.toxicity(docs, model).collect():
        assert r.predicted == (r.score >= 0.5)
    for text in TEXTS:
        words = toxicity.words_of(text)
        tops = [0.0] * len(toxicity.SIZES)
        if words:
            grams = [toxicity.ngrams([w])[0] for w in words]
            values = [float(np.mean(model.gram[g].astype(float))) for g in grams]
            tops = [max(plain_stretches(values, words, size)) for size in toxicity.SIZES]
        odds = max((t - b) / u for t, b, u in zip(tops, model.borders, model.units))
        assert np.isclose(model.score(text), 1 / (1 + np.exp(-np.clip(odds, -30, 30))), atol=1e-5)


# --- packing ---

@pytest.mark.parametrize("times, share", [(1, 0.6), (1000, 0.9)])
def test_the_linear_program_places_most_pieces(spark, monkeypatch, times, share):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = packing.cut_pieces(docs, *PATHS[:3]).groupBy("length").count().collect()
    counts = {r.length: r["count"] * times for r in pieces}
    plain, given = packing.Plan(packing.CAPACITY), []
    best_fit = packing.best_fit
    best_fit(dict(counts), packing.CAPACITY, plain)

    def noted(left, capacity, plan):
        given.append(sum(left.values()))
        best_fit(left, capacity, plan)

    monkeypatch.setattr(packing, "best_fit", noted)
    plan = packing.make_plan(counts)
    short = sum(n for k, n in counts.items() if k < packing.CAPACITY)
    # The first call is best fit alone, for comparison; the last is the one that counts.
    assert given[-1] <= (1 - share) * short
    assert plan.sequences <= plain.sequences
    assert max(Counter(row[0] for row in plan.rows).values()) <= packing.CAPACITY
    for length, n in counts.items():
        own = sorted((low, high) for k, low, high, *_ in plan.rows if k == length)
        assert own[0][0] == 0 and own[-1][1] == n
        assert all(a[1] == b[0] for a, b in zip(own, own[1:]))


# --- near vectors: ids ---

def test_null_and_text_ids_of_vectors(spark):
    near, far = [1.0, 0.01, 0.0], [0.0, 0.0, 1.0]
    rows = [("b", near), ("a", [1.0, 0.0, 0.0]), (None, [1.0, 0.02, 0.0]), ("c", far),
            (None, [0.0, 1.0, 0.0]), (None, None), ("d", None), ("c", far)]
    table = spark.createDataFrame(rows, "vec_id string, embedding array<double>")
    found = sorted(((r.vec_id or "", r.n_links, r.component_id or "", r.kept)
                    for r in embeddings.near_vectors(table).collect()))
    assert found == sorted([
        ("b", 2, "a", False), ("a", 2, "a", True), ("", 2, "a", False), ("c", 1, "c", True),
        ("", 0, "", True), ("", 0, "", True), ("d", 0, "d", True), ("c", 1, "c", True)])
    numbers = spark.createDataFrame([(1, near), (None, near), (5, near)],
                                    "vec_id long, embedding array<double>")
    assert sorted(str(r.component_id) for r in embeddings.near_vectors(numbers).collect()) == ["1"] * 3


# --- pages ---

@pytest.mark.parametrize("name", [
    "reader-comments", "comments-section", "comment-section", "user-comments", "article-comments",
    "post-comments", "page-footer", "cookie-consent", "newsletter-signup", "advertising",
    "advertorial", "notice-message", "side-bar", "replies", "discussion", "login", "paid-content",
    "modal"])
def test_side_parts_inside_an_article(name):
    page = f"<article><p>One text.</p><div class='x {name}'><p>Not this.</p></div><p>Two.</p></article>"
    assert wrappers.Extractor(wrappers.Wrapper().packed()).text(page) == "One text.\nTwo."


@pytest.mark.parametrize("name", ["no-sidebar", "post", "article-body", "content", "notice2me",
                                  "commentary", "main-content", "user-guide"])
def test_other_classes_stay(name):
    page = f"<article><div class='{name}'><p>One text.</p></div><p>Two.</p></article>"
    assert wrappers.Extractor(wrappers.Wrapper().packed()).text(page) == "One text.\nTwo."


def test_drawings_with_and_without_end():
    page = "<article><p>a<svg viewBox='0 0 1 1' x=\"a/>b\"/>b</p><svg><path d='1'/>no</svg><p>c</p></article>"
    assert wrappers.Extractor(wrappers.Wrapper().packed()).text(page) == "ab\nc"
