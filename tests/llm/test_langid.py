import zlib

import pytest

from hackney.llm import langid
from hackney.llm.registry import QUERIES
from tests.llm.helpers import documents


def test_ngrams_are_those_of_padded_words():
    got = sorted(langid.ngrams("Ab, c!").tolist())

    def code(s):
        n = 0
        for ch in s:
            n = n << 21 | ord(ch)
        return n

    want = ["a", "b", "c", " a", "ab", "b ", " c", "c ", " ab", "ab ", " c "]
    assert got == sorted(map(code, want))
    assert not len(langid.ngrams("")) and not len(langid.ngrams("12 $%"))


def test_distance_by_definition():
    """Against ranks in plain dictionaries."""
    size = 20
    texts = {"en": "the cat and the dog and the bird", "fr": "le chat et le chien et les oiseaux"}
    profiles = {}
    import numpy as np
    for lang, text in texts.items():
        own = langid.ranked(langid.ngrams(text), size)
        order = np.argsort(own)
        profiles[lang] = own[order], order
    text = "the dog and le chat"
    own = langid.ranked(langid.ngrams(text), size).tolist()
    got = langid.distances(text, profiles, size)
    for k, lang in enumerate(texts):
        ranks = {c: r for r, c in enumerate(langid.ranked(langid.ngrams(texts[lang]), size).tolist())}
        want = sum(abs(ranks[c] - r) if c in ranks else size for r, c in enumerate(own))
        assert abs(got[k] - want / (size * len(own))) < 1e-12
    assert got[0] != got[1] and langid.distances("", profiles, size) is None


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op8_language_id"](spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas()
    both = got.merge(docs, on="doc_id")
    assert len(both) == len(docs) and list(got.columns) == ["doc_id", "held_out", "lang_pred", "score"]
    assert both.held_out.tolist() == [zlib.crc32(str(i).encode()) % 4 == 2 for i in both.doc_id]
    held = both[both.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.98 and both.score.between(0, 1).all()


def test_cases(spark):
    rows = [(1, "the the and of the", "en"), (2, "le la les et de", "fr"), (3, None, "en"), (4, "", None), (5, "12 !", "en"),
            (None, "the", None), (6, "the", None), (6, "the", None), (7, "日本", None), (8, "le " * 50000, None)]
    docs = documents(spark, rows)
    profiles = langid.learn(docs)
    assert sorted(profiles) == ["en", "fr"]
    got = [(r.doc_id, r.lang_pred) for r in langid.identify(docs, profiles).collect()]
    assert len(got) == len(rows)
    assert dict(got) == {1: "en", 2: "fr", 3: "und", 4: "und", 5: "und", None: "en", 6: "en", 7: "en", 8: "fr"}
    assert all(r.lang_pred == "und" and r.score == 0 for r in langid.identify(docs, {}).collect())
    empty = documents(spark, [])
    assert langid.learn(empty) == {} and langid.identify(empty, {}).count() == 0


@pytest.mark.parametrize("number", [None, 0, 3])
def test_documents_that_share_an_id_teach(spark, number):
    """The sample is drawn by id and text, at most ``per_language`` distinct ones, whatever the ids."""
    rows = [(number, f"the house and the garden {i}", "en") for i in range(60)]
    rows += [(number, f"das haus und der garten {i}", "de") for i in range(60)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = langid.learn(docs, per_language=20)
    assert sorted(profiles) == ["de", "en"]
    got = langid.identify(docs, profiles, keep=("lang",)).collect()
    assert len(got) == 240 and all(r.lang_pred == r.lang for r in got)
