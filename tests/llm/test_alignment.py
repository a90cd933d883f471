import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from hackney.llm import alignment
from hackney.llm.wordtok import byte_chars
from tests.llm.helpers import documents, prose, rng

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _tokens(text):
    """(id, start, end) of A and of B over the bytes of space+text; None if they stand for others."""
    first = Tokenizer.from_file(PATHS[0])
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    byte_of = {c: b for b, c in byte_chars().items()}
    a = [(i, bytes(byte_of[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
    out = []
    for side in (a, b):
        at, found = 0, []
        for i, raw in side:
            found.append((i, at, at + len(raw)))
            at += len(raw)
        if b"".join(raw for _, raw in side) != (" " + text).encode():
            return None
        out.append(found)
    return out


def _brute(rows):
    linked, docs = [], defaultdict(int)
    for _, text in rows:
        tokens = _tokens(text) if text else None
        pairs = [] if not tokens else [(x[0], y[0]) for x in tokens[0] for y in tokens[1] if x[1] < y[2] and y[1] < x[2]]
        linked.append((tokens, pairs))
        for pair in set(pairs):
            docs[pair] += 1
    best = defaultdict(int)
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    out = []
    for (i, _), (tokens, pairs) in zip(rows, linked):
        if not tokens:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b = tokens
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups = ["|".join(",".join(str(x[0]) for x in side if low <= x[1] and x[2] <= high) for side in (a, b))
                  for low, high in zip([0, *cuts], cuts)]
        out.append((i, len(a), len(b), len(groups), len(pairs), sum(docs[p] == best[p[0]] for p in pairs),
                    sum(docs[p] for p in pairs), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


def _rows():
    r = rng(11)
    odd = ["a", " ", "  ", " a", "a ", "a  b", "\n", "a\nb", "a \n b", "a \u00a0b", "a\u3000b c", "\ta\t b", "it's we'll DON'T x's",
           "<|endoftext|> and <s> </s> <unk> <0x41>", "a ▁ marker", "▁", "é ü ß ñ", "日本語 テスト", "🙂 🙂🙂 x", "e\u0301 e", "\x00 \x1c\x1d x",
           "12 345.678 -9", "http://a.b/c?d=e&f", "x" * 3000, "Ⅷ ½ ﬁ", "a\r\nb\r\n", "\u2028 a", "\ufeffa b", "the the the"]
    rows = [(i, x) for i, x in enumerate(odd)]
    rows += [(100 + i, prose(r, r.randint(1, 60)) + r.choice(["", ".", "\n", " Zürich, 東京!"])) for i in range(40)]
    return rows + [(200, None), (201, ""), (202, rows[40][1]), (202, rows[40][1]), (None, "an id is missing"), (None, None)]


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_digests_equal_brute_force(spark, bound, monkeypatch):
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", bound)
    rows = _rows()
    got = alignment.digests(documents(spark, rows), *PATHS)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = Counter(_brute(rows))
    assert Counter(map(tuple, got.collect())) == want
    assert sum(r[1] == 0 for r in want) >= 3  # texts without tokens are among them
    assert alignment.digests(documents(spark, []), *PATHS).count() == 0


def test_small_caches_change_nothing(monkeypatch):
    texts = [t for _, t in _rows()]
    with open(PATHS[0]) as a, open(PATHS[1], "rb") as b:
        spec, model = a.read(), b.read()
    whole = list(alignment.Aligner(spec, model).texts(texts))
    monkeypatch.setattr(alignment, "CACHE_UNITS", 3)
    monkeypatch.setattr(alignment, "CACHE_GROUPS", 2)
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 50)
    small = alignment.Aligner(spec, model)
    assert list(small.texts(texts)) == whole and small.by_unit
    small.by_unit = False  # a text as one unit
    join = lambda found: (sum(x.n_a for x in found), ";".join(x.text for x in found), b"".join(x.pairs for x in found))
    assert [join(x) for x in small.texts(texts)] == [join(x) for x in whole]


def test_links_of_a_slice_are_those_that_overlap():
    r = rng(12)
    for _ in range(300):
        size = r.randint(1, 30)
        ends = [sorted({*r.sample(range(1, size + 1), r.randint(0, size)), size}) for _ in range(2)]
        groups = alignment.align(*ends)
        assert len(groups) == len(set(ends[0]) & set(ends[1]))
        assert groups[0][0] == groups[0][2] == 0 and groups[-1][1::2] == (len(ends[0]), len(ends[1]))
        spans = [[(a, b) for a, b in zip([0, *side], side)] for side in ends]
        want = [(i, k) for i, x in enumerate(spans[0]) for k, y in enumerate(spans[1]) if x[0] < y[1] and y[0] < x[1]]
        assert sorted(link for group in groups for link in alignment.links(*ends, group)) == want
