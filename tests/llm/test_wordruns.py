import hashlib
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hackney.llm import wordruns as W
from tests.llm.helpers import documents, prose, rng


def _brute(words, least=6, times=4):
    """Every maximal stretch whose words are q apart identical, less those of a smaller period."""
    found, n = [], len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            size = i + q - start
            if size >= max(least, times * q) and not any(
                    all(words[k] == words[k + p] for k in range(start, start + size - p)) for p in range(1, q)):
                found.append((start, size, q))
            i += 1
    return sorted(found, key=lambda x: (x[0], x[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 9), st.integers(0, 10))
def test_runs_equal_brute_force(words, period, start):
    planted = words[:start] + [words[start + (i - start) % period] for i in range(start, len(words))
                               if start + period <= len(words)]
    for w in (words, planted, planted + words):
        for least, times in ((6, 4), (2, 2), (5, 3)):
            assert W.find_runs(w, least, times) == _brute(w, least, times)


def test_known_runs():
    assert W.find_runs(list("xaaaaaay")) == [(1, 6, 1)]
    assert W.find_runs(list("aaaaa")) == []
    assert W.find_runs(list("abababab")) == [(0, 8, 2)] and W.find_runs(list("abababa")) == []
    assert W.find_runs(list("babababababab" + "bbbbbb")) == [(0, 13, 2), (12, 7, 1)]
    assert W.find_runs(["w"] * 50_000) == [(0, 50_000, 1)]
    long = [str(i % 9_999) for i in range(50_000)]
    assert W.find_runs(long) == [(0, 50_000, 9_999)]


def test_pieces_keep_every_word_of_a_run():
    r = rng(7)
    for _ in range(200):
        words = [r.choice("abcdefgh") for _ in range(r.randint(0, 60))]
        at, q = r.randint(0, 60), r.randint(1, 6)
        words[at:at] = [r.choice("abz") for _ in range(q)] * r.randint(4, 6)
        kept = {i for a, b in W.pieces(words) for i in range(a, b)}
        assert all(i in kept for s, n, _ in _brute(words) for i in range(s, s + n))


def _row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is not None and words and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g, n = zlib.crc32(str(doc_id).encode()) // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = _brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    best = sorted(runs, key=lambda x: (-x[1], x[0], x[2]))[:1]
    of_best = (*best[0], 1000 * best[0][1] // best[0][2]) if best else (None,) * 4
    return (doc_id, len(runs), *of_best, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_documents_equal_brute_force(spark):
    r = rng(8)
    rows = [(i, prose(r, r.randint(0, 60))) for i in range(120)]
    rows += [(200 + i, " \n".join(["de la", "x"][: 1 + i % 2] * r.randint(1, 9)) + "\u00a0\u3000 \x1c y") for i in range(12)]
    rows += [(300, None), (301, ""), (302, " \t\n\v\f\r "), (303, rows[5][1]), (303, rows[5][1]), (None, "no id " * 5), (None, None),
             (-7, "neg " * 8), (304, "w " * 3000)]
    rows += [(i, "a b c " * 8) for i in range(400, 440)]
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = W.collapse(documents(spark, rows), prepare=W.planted).select(columns).collect()
    key = lambda t: (t[0] is None, t[0] or 0, str(t[1:]))
    assert sorted(map(tuple, got), key=key) == sorted((_row(*x) for x in rows), key=key)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, t in rows if t)
    assert W.collapse(documents(spark, [])).count() == 0


def test_collapsed_text_and_runs(spark):
    got = W.collapse(documents(spark, [(1, "so  he he he\the he he said"), (2, None)]), with_text=True)
    assert {r.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()} == {
        1: (8, [(1, 6, 1)], "so he said"), 2: (0, [], "")}


@pytest.mark.parametrize("n", [1, 2, 50])
def test_access_gives_the_paths_segments(n):
    """Against paths that are coloured node by node."""
    r = rng(n)
    parents = [0, *[r.randint(0, i) for i in range(n)]]
    paths, colours = W.LinkCut(list(parents)), [-1] * (n + 1)
    for time in range(200):
        x = r.randint(1, n)
        path = [x]
        while parents[path[-1]]:
            path.append(parents[path[-1]])
        want, last = [], None
        for node in path:  # from the deepest up; a new segment where the colour changes
            if colours[node] != last and colours[node] >= 0:
                want.append((node, colours[node]))
            last = colours[node]
        assert paths.access(x, time) == want
        for node in path:
            colours[node] = time
