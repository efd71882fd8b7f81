"""Operators on pairs of rows, and the pipeline, against brute force and on edge rows."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import embeddings, graph, jaccard
from millrace.llm.language import fit_languages, languages
from millrace.llm.quality import fit_quality, quality_rules

SF = "/root/testdata/sf0.001"


class Union:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)


# --- components ---

@pytest.mark.parametrize("shape", ["path", "star", "random", "cycle"])
def test_components(spark, shape):
    random.seed(7)
    links = {
        "path": [(i, i + 1) for i in range(40)], "star": [(50, i) for i in range(49)],
        "cycle": [(i, (i + 1) % 17) for i in range(17)],
        "random": [(random.randrange(120), random.randrange(120)) for _ in range(80)],
    }[shape]
    found = graph.components(spark.createDataFrame(links + links[:3] + [(5, 5)], "a long, b long"),
                             "a", "b").collect()
    union = Union(range(121))
    for a, b in links:
        union.join(a, b)
    assert {r.node: r.component for r in found} == {
        i: union.root(i) for i in union.up if union.root(i) != i}


def test_no_links(spark):
    empty = spark.createDataFrame([], "a long, b long")
    assert graph.components(empty, "a", "b").count() == 0


# --- Jaccard join ---

def brute(rows, words, num, den):
    """Set sizes and components, by comparing all pairs."""
    sets = {}
    for i, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        found = re.findall(r"[^\x20\x09-\x0D]+", lower)
        sets.setdefault(i, []).append(frozenset(
            tuple(found[k:k + words]) for k in range(max(len(found) - words + 1, 1)))
            if found else frozenset())
    union, flat = Union(sets), [(i, s) for i, own in sets.items() for s in own if s]
    for k, (i, s) in enumerate(flat):
        for j, t in flat[:k]:
            if den * len(s & t) >= num * len(s | t):
                union.join(i, j)
    return {i: len(own[0]) for i, own in sets.items()}, {i: union.root(i) for i in sets}


def near_copies(seed):
    """Texts in groups, with shared passages, copies, edge texts and repeated rows."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = rng.choices(vocabulary, k=60)
    rows = []
    for _ in range(25):
        base = rng.choices(vocabulary, k=rng.choice([4, 12, 40, 150]))
        if rng.random() < 0.5:
            base += passage
        for _ in range(rng.choice([1, 1, 2, 6])):
            text = list(base)
            for _ in range(int(rng.random() * 0.06 * len(base))):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append(" ".join(text))
    rows += ["", None, " \n", "one", "ONE", "one two", "one\ttwo", "É é", "é é", "a a a a a a"]
    rng.shuffle(rows)
    table = list(enumerate(rows))
    return table + table[:4]


@pytest.mark.parametrize("words, num, seed", [(3, 90, 1), (5, 80, 2), (1, 95, 3)])
@pytest.mark.parametrize("most", [1024, 3])
def test_jaccard_equals_brute_force(spark, monkeypatch, words, num, seed, most):
    """Small limits send the groups through the pivots and blocks of large regions."""
    monkeypatch.setattr(jaccard, "REGION_DOCS", most)
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", most)
    rows = near_copies(seed)
    docs = spark.createDataFrame([(i, t, 1, "n") for i, t in rows],
                                 "doc_id long, text string, component_id int, id string")
    sizes, classes = brute(rows, words, num, 100)
    found = jaccard.jaccard_components(docs.repartition(5), words, num).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: r.n_shingles for r in found} == sizes
    assert {r.doc_id: r.component_id for r in found} == classes
    assert len(set(classes.values())) < len(classes)


def test_keep_one_of_each_group(spark):
    rows = near_copies(4)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, id string")
    _, classes = brute(rows, 5, 80, 100)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    texts = dict(rows)
    left = sorted(r.doc_id for r in kept.collect())
    # Repeated rows with words become one; rows without words link with nothing and all stay.
    wordless = [i for i, t in rows if not (t or "").split()]
    assert left == sorted([i for i in set(classes.values()) if (texts[i] or "").split()] + wordless)


def test_jaccard_edge_tables(spark):
    schema = "doc_id long, text string"
    assert jaccard.jaccard_components(spark.createDataFrame([], schema)).count() == 0
    assert jaccard.keep_one(spark.createDataFrame([], schema)).count() == 0
    nulls = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "a b"), (2, None)], schema)
    found = jaccard.jaccard_components(nulls).collect()
    assert sorted((str(r.doc_id), r.n_shingles) for r in found) == [
        ("1", 1), ("2", 0), ("None", 1), ("None", 1)]
    copies = spark.createDataFrame([(i, "the same text in all of the rows") for i in range(300)], schema)
    assert {r.component_id for r in jaccard.jaccard_components(copies).collect()} == {0}


def test_long_text_shingles():
    text = "lorem ipsum dolor sit amet " * 50_000
    assert len(jaccard.shingles(text, 3)) == 5
    words = [str(k) for k in range(30_000)]
    assert len(jaccard.shingles(" ".join(words), 3)) == 29_998
    assert (jaccard.shingles("A b\tC", 3) == jaccard.shingles("a B\nc", 3)).all()


# --- embeddings ---

def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 40)
    monkeypatch.setattr(embeddings, "STRIPE", 7)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16))
    vectors = centres[rng.integers(0, 20, 200)] + rng.normal(size=(200, 16)) * rng.choice(
        [0.05, 0.3, 0.6], (200, 1))
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    rows += [(300 + k, rows[7][1]) for k in range(30)] + [(400, [2 * x for x in rows[7][1]])]
    odd = [(500, None), (501, []), (502, [0.0] * 16), (503, [float("nan")] * 16),
           (504, [float("inf")] + [0.0] * 15), (505, [None] + [1.0] * 15), (506, [1.0, 2.0]),
           (507, [1.0, 2.0]), (508, [1e-30] * 16), (509, [1e30] * 16), (510, [-0.0] * 15 + [1.0]),
           (511, [0.0] * 15 + [1.0])]
    table = spark.createDataFrame([(i, v, 0, True) for i, v in rows + odd],
                                  "vec_id long, embedding array<float>, label int, kept boolean")
    usable = [(i, v) for i, v in rows + odd if i not in (500, 501, 502, 503, 504, 505)]
    links, union = {i: 0 for i, _ in rows + odd}, Union([i for i, _ in rows + odd])
    for k, (i, v) in enumerate(usable):
        for j, w in usable[:k]:
            if len(v) == len(w):
                x, y = (np.array(np.float32(u), dtype=np.float64) for u in (v, w))
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9:
                    links[i] += 1
                    links[j] += 1
                    union.join(i, j)
    found = embeddings.near_vectors(table).collect()
    assert len(found) == len(rows) + len(odd)
    assert {r.vec_id: r.n_links for r in found} == links
    assert {r.vec_id: r.component_id for r in found} == {i: union.root(i) for i in links}
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert embeddings.near_vectors(empty).count() == 0


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(6)
    a = embeddings.unit(rng.normal(size=(200, 48)))
    whole, scale, rest, length = embeddings.quantise(a)
    assert np.abs(whole).max() <= 127 and (whole == np.rint(whole)).all()
    near = (whole @ whole.T) * scale[:, None] * scale
    bound = length[:, None] * rest + rest[:, None] * length + rest[:, None] * rest
    assert (np.abs(a @ a.T - near) <= bound).all() and bound.max() < 0.05


# --- pipeline ---

def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "quality", "near_duplicates", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    odd = spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "123 456", "en", "s", 7)],
                                docs.schema)
    now = docs.unionByName(odd)
    language, quality, near, packing = (stage for _, stage in corpus_pipeline.STAGES)
    kept = language(spark, now, SF)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {
        r.doc_id for r in languages(now, fit_languages(now)).where("lang_pred <> 'und'").collect()}
    good = quality(spark, kept, SF)
    model = fit_quality(kept, spark.read.parquet(f"{SF}/labels.parquet"))
    assert {r.doc_id for r in good.collect()} == {
        r.doc_id for r in quality_rules(kept, model).where("kept").collect()}
    single = near(spark, good, SF)
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert {r.doc_id for r in single.collect()} == set(brute(rows, 5, 80, 100)[1].values())
    packed = packing(spark, single, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in single.collect()}
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} <= set(texts)


def test_stages_on_no_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
