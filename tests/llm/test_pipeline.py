"""The pipeline against a brute-force version of its stages."""

import sys
from pathlib import Path

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as P  # noqa: E402
from hackney.llm import langid  # noqa: E402
from tests.llm.helpers import documents, prose, rng, similar  # noqa: E402
from tests.llm.test_linededup import _brute  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _corpus():
    r = rng(12)
    base = [prose(r, 60) for _ in range(12)]
    rows = [(i, f"{t}\n{prose(r, 5)}", "en") for i, t in enumerate(base)]
    for k in range(8):
        words = base[k].split()
        words[0] = "changed"
        rows.append((50 + k, " ".join(words), "en"))          # near copies, one line each
    rows += [(80, rows[0][1], "en"), (81, None, "en"), (82, "12 34 !!", "en"), (83, "", None), (84, "word", None),
             (85, prose(r, 4000), "en"), (86, "shared footer line here\n" + prose(r, 20), "en"),
             (87, "shared footer line here\n" + prose(r, 20), "en")]
    return rows


def test_stages_equal_brute_force(spark):
    rows = _corpus()
    docs = documents(spark, rows).select(*COLUMNS)

    kept = P.identify_language(spark, docs, "").cache()
    assert kept.columns == COLUMNS
    profiles = langid.learn(docs)
    want = set()
    for i, text, _ in rows:
        far = langid.distances(text, profiles, langid.PROFILE_SIZE) if text else None
        if far is not None and 1 - far.min() >= P.LEAST_SCORE:
            want.add(i)
    assert {r.doc_id for r in kept.collect()} == want and {81, 82, 83}.isdisjoint(want) and 0 in want

    lined = P.dedup_lines(spark, kept, "").cache()
    assert lined.columns == COLUMNS
    before = {r.doc_id: r.text for r in kept.collect()}
    after = {}
    for i, _, _, gone in _brute(sorted(before.items()), 1, 16):
        lines = [x for n, x in enumerate(before[i].split("\n")) if n not in gone]
        if not gone or "".join(lines).strip():
            after[i] = "\n".join(lines)
    assert {r.doc_id: r.text for r in lined.collect()} == after and 80 not in after
    assert all(r.n_chars == len(r.text) for r in lined.collect())

    once = P.dedup_near(spark, lined, "").cache()
    assert once.columns == COLUMNS
    component = similar(list(after.items()), 5)
    assert {r.doc_id for r in once.collect()} == {i for i, c in component.items() if i == c}
    assert len(set(component.values())) < len(component)

    packed = P.pack(spark, once, "").toPandas()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in once.collect():
        n = len(library.encode(r.text, add_special_tokens=False).ids) + 1
        assert packed[packed.doc_id == r.doc_id].length.sum() == n
    assert (packed.groupby("sequence_id").length.sum() <= 2048).all()


def test_run_over_the_small_table(spark):
    sf = "/root/testdata/sf0.001"
    got = P.run(spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == COLUMNS
    assert set(got.doc_id) == {r.doc_id for r in docs.collect()} and 0 < len(set(got.doc_id)) <= 200
    assert np.all(got.length <= 2048)


def test_odd_tables(spark):
    """Empty tables, repeated rows, NULL ids and documents without labels."""
    empty = documents(spark, []).select(*COLUMNS)
    rows = [(1, "some words here", None), (1, "some words here", None), (None, "other words here", None), (2, None, None)]
    odd = documents(spark, rows).select(*COLUMNS)
    assert {len(stage(spark, empty, "").collect()) for _, stage in P.STAGES} == {0}
    kept = P.identify_language(spark, odd, "")
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "None"]
    once = P.dedup_near(spark, P.dedup_lines(spark, kept, ""), "")
    assert sorted(str(r.doc_id) for r in once.collect()) == ["1", "None"]
