"""Embedding and document near-duplicates, and the components under them."""

import math

import numpy as np
import pytest

from hackney.llm import minhash, sphericalcaps
from hackney.llm.components import components
from tests.llm.helpers import documents, pairs_to_components, prose, rng, similar


def test_components_equal_union_find(spark):
    r = rng(4)
    links = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(180)]
    links += [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7), (2000, 2001), (2001, 2000)]  # a chain
    got = {x.node: x.component for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = pairs_to_components({n for link in links for n in link}, links)
    assert {n: got.get(n, n) for n in want} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("nodes", [3, 40, 500_000])
def test_components_with_hubs(spark, monkeypatch, nodes):
    """A hub whose pairs meet it by broadcast, and others by shuffle, as beyond the bound on nodes."""
    monkeypatch.setattr("hackney.llm.components.BROADCAST_NODES", nodes)
    r = rng(11)
    links = [(500, i) for i in range(0, 400, 2)] + [(r.randrange(600, 900), r.randrange(600, 900)) for _ in range(150)]
    links += [(i, i + 1) for i in range(901, 930)] + [(500, 500), (2, 500), (500, 2)]
    got = {x.node: x.component for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = pairs_to_components({n for link in links for n in link}, links)
    assert got == {n: c for n, c in want.items() if n != c}


# -- vectors ------------------------------------------------------------------

def _brute_vectors(vectors, cosine=0.95):
    units = {}
    for i, v in vectors:
        u = None
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            u = np.array(v, float)
            u = u / np.linalg.norm(u)
        units[i] = u
    ids = [i for i in units if i is not None]
    links = [(a, b) for a in ids for b in ids if a < b and units[a] is not None and units[b] is not None
             and len(units[a]) == len(units[b]) and units[a] @ units[b] >= cosine]
    comp = pairs_to_components(ids, links)
    n = {i: sum(i in link for link in links) for i in ids}
    return {i: (n[i], comp[i], comp[i] == i) for i in ids}


def _run_vectors(spark, vectors):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in vectors],
                               "vec_id long, embedding array<float>, rep string, component_id string")
    found = sphericalcaps.near_duplicates(df)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    return [(r.vec_id, (r.n_links, r.component_id, r.kept)) for r in found.collect()]


def test_vectors_equal_brute_force_in_crowded_caps(spark, monkeypatch):
    monkeypatch.setattr(sphericalcaps, "CHUNK", 16)  # caps of several chunks
    r = np.random.default_rng(1)
    vectors = [(i, r.standard_normal(32).astype(np.float32).tolist()) for i in range(120)]
    base = r.standard_normal(32)
    vectors += [(200 + i, (base + 0.1 * r.standard_normal(32)).astype(np.float32).tolist()) for i in range(70)]
    vectors += [(300 + i, vectors[5][1]) for i in range(12)]  # copies
    vectors += [(400, None), (401, []), (402, [0.0] * 32), (403, [math.nan] + [1.0] * 31), (404, [1.0, 2.0]),
                (405, [2.0, 4.0]), (406, [None] + [1.0] * 31), (407, [1e30] * 32), (408, [1e-30] * 32)]
    got = _run_vectors(spark, vectors)
    assert dict(got) == _brute_vectors(vectors) and len(got) == len(vectors)


def test_vectors_null_ids_repeats_and_empty(spark):
    vectors = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (2, [1.0, 0.0])]
    got = _run_vectors(spark, vectors)
    assert sorted(got, key=str) == sorted([(1, (1, 1, True)), (1, (1, 1, True)), (None, (0, None, True)),
                                           (2, (1, 1, False))], key=str)
    assert _run_vectors(spark, []) == []


def test_decoding_lists_the_best_directions():
    r = np.random.default_rng(2)
    for dim in (8, 64):
        unit = r.standard_normal(dim)
        unit /= np.linalg.norm(unit)
        words = sphericalcaps.codewords(100)
        rotation, books = sphericalcaps._code(dim, words)
        score = np.zeros(1)
        for book, part in zip(books, np.array_split(rotation @ unit, len(books)), strict=True):
            score = (score[:, None] + book @ part).ravel()
        count = sphericalcaps.passed(words ** len(books))
        assert sphericalcaps.decode(unit, words).tolist() == sorted(np.argsort(-score)[:count].tolist())


def test_recall_at_the_threshold():
    """Pairs of cosine 0.95 exactly, the hardest that count, at the size of 50,000 vectors."""
    r = np.random.default_rng(3)
    words, met = sphericalcaps.codewords(50_000), 0
    for _ in range(400):
        a, b = r.standard_normal((2, 64))
        a /= np.linalg.norm(a)
        b -= b @ a * a
        b = 0.95 * a + math.sqrt(1 - 0.95 ** 2) * b / np.linalg.norm(b)
        met += len(np.intersect1d(sphericalcaps.decode(a, words), sphericalcaps.decode(b, words))) > 0
    assert met / 400 >= 0.98


# -- documents ----------------------------------------------------------------

def test_signatures_are_unbiased_with_less_variance():
    r = np.random.default_rng(0)
    errors = []
    for _ in range(150):
        u = np.unique(r.integers(0, 2 ** 63, 400).astype(np.uint64))
        a, b = u[:360], u[40:]
        s = minhash.signatures([a, b], 120)
        errors.append((s[0] == s[1]).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < math.sqrt(0.8 * 0.2 / 120)


def test_signature_of_one_element_is_its_permutation():
    """And signing sets together or alone gives the same."""
    sets = [np.array([5], np.uint64), np.arange(9, dtype=np.uint64), np.arange(2000, dtype=np.uint64)]
    together = minhash.signatures(sets, 60)
    assert sorted((together[0] >> np.uint64(32)).tolist()) == list(range(60))
    for row, s in zip(together, sets, strict=True):
        assert (minhash.signatures([s], 60)[0] == row).all()
    # The least over elements: signatures of unions are the slot-wise least.
    union = minhash.signatures([np.arange(3, dtype=np.uint64), np.arange(3, 9, dtype=np.uint64)], 60).min(axis=0)
    assert (union == together[1]).all()


def test_histograms_bound_intersections():
    r = np.random.default_rng(5)
    for _ in range(60):
        u = np.unique(r.integers(0, 2 ** 63, r.integers(1, 900)).astype(np.uint64))
        a, others = u[r.random(len(u)) < 0.8], [u[r.random(len(u)) < p] for p in (0.3, 0.8, 0.95)]
        others = [o for o in others if len(o)]
        if not len(a) or not others:
            continue
        bounds = minhash.intersection_bounds(minhash.histogram(a), [minhash.histogram(o) for o in others])
        both = [len(np.intersect1d(a, o)) for o in others]
        assert all(b <= x <= min(len(a), len(o)) for b, x, o in zip(both, bounds, others, strict=True))
    same = minhash.histogram(u)
    assert minhash.intersection_bounds(same, [same])[0] == len(u)


@pytest.mark.parametrize("words", [1, 2, 5])
def test_shingle_sets(words):
    from tests.llm.helpers import shingles
    for text in ["", " \t\r\n ", "One", "one two", "A b a B a b", "x" * 5000, "é É e", "a\x0bb\x1cc\xa0d"] + \
            [prose(rng(i), 30) for i in range(5)]:
        assert len(minhash.shingle_set(text.encode(), words)) == len(shingles(text, words))


def _rows():
    r = rng(9)
    base = [prose(r, r.randint(40, 120)) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(base)]
    for k in range(90):  # near copies of a few documents, chains among them
        words = base[k % 6].split()
        for _ in range(r.randint(0, 6)):
            words[r.randrange(len(words))] = prose(r, 1)
        rows.append((100 + k, " ".join(words)))
    rows += [(300 + k, base[7].upper()) for k in range(20)]  # exact copies but for case
    rows += [(400, None), (401, ""), (402, "  "), (403, "one"), (404, "ONE"), (405, "one two"), (406, "x" * 20000)]
    return rows


def test_documents_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CHUNK", 8)  # buckets of several chunks
    rows = _rows()
    for words in (2, 5):
        got = minhash.near_duplicates(documents(spark, rows), words=words)
        assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
        got = {r.doc_id: (r.component_id, r.kept) for r in got.collect()}
        want = similar(rows, words)
        assert got == {i: (c, i == c) for i, c in want.items()}


def test_documents_null_ids_repeats_and_empty(spark):
    text = prose(rng(1), 50)
    rows = [(5, text), (5, text), (5, "another thing altogether, which is another set"), (None, text), (2, text), (9, None)]
    got = minhash.near_duplicates(documents(spark, rows)).collect()
    assert len(got) == 6
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(5, 2, False), (None, None, True), (2, 2, True), (9, 9, True)}
    assert minhash.near_duplicates(documents(spark, [])).count() == 0
