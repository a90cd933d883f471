"""Periodic runs of words, by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with a smallest period q (words q apart
are identical), of at least ``least`` words and ``times`` periods, that no
neighbouring word extends. A stretch's words make a suffix automaton. Then each
word in turn accesses its prefix's state in a link-cut tree over the suffix links:
the access makes the path to the root one preferred path, whose colour is the
word's place. The paths that it runs through, as they were, are segments of states
with one last occurrence: from a segment whose deepest state has L words and which
ended at place j before it ends at i, the words j - L + 1 .. i have period p = i - j.
With L >= p this is a square that ends at i; with L + p >= times * p it is a part
of a run, which later words extend. The run of period q is met as such at each of
its places from the one on that completes ``times`` periods: a more recent
occurrence of the same words would give it a smaller period.

Before that, a document is cut at words that occur fewer than ``times`` times in
it, and the pieces again at words that do so in the piece: a run holds each of its
words ``times`` times and so lies in one piece. What is cut off is in no run.

Defined cases: a NULL text has no words; an empty or blank one neither; a NULL
id is kept; rows that repeat an id are documents of their own; an empty table
gives no rows; other columns are not read. Texts are processed whole.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import ship_package

#: Fixed values of the contract: the words and periods a run has at least.
LEAST, TIMES = 6, 4


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix links and lengths of a suffix automaton's states (0 is the root), and the state of each prefix."""
    link, length, after, prefixes = [-1], [0], [{}], []
    last = 0
    for word in words:
        state = len(link)
        length.append(length[last] + 1)
        after.append({})
        link.append(0)
        at = last
        while at >= 0 and word not in after[at]:
            after[at][word] = state
            at = link[at]
        if at >= 0:
            to = after[at][word]
            if length[to] == length[at] + 1:
                link[state] = to
            else:
                clone = len(link)
                length.append(length[at] + 1)
                after.append(after[to].copy())
                link.append(link[to])
                while at >= 0 and after[at].get(word) == to:
                    after[at][word] = clone
                    at = link[at]
                link[to] = link[state] = clone
        prefixes.append(state)
        last = state
    return link, length, prefixes


class LinkCut:
    """Preferred paths of a rooted forest as splay trees; each path has one colour.

    Nodes are numbered from 1; parent 0 is none.
    """

    def __init__(self, parents: list[int]):
        self.up = parents  # the parent in the splay tree, or of the path's top
        self.left, self.right = [0] * len(parents), [0] * len(parents)
        self.colour = [-1] * len(parents)  # of the path, kept at the root of its splay tree

    def _rotate(self, x: int) -> bool:
        """Turns ``x`` above its parent in the splay tree; whether it is the root then."""
        up, left, right = self.up, self.left, self.right
        y = up[x]
        z = up[y]
        if left[y] == x:
            left[y] = moved = right[x]
            right[x] = y
        else:
            right[y] = moved = left[x]
            left[x] = y
        if moved:
            up[moved] = y
        up[x], up[y] = z, x
        if z and left[z] == y:
            left[z] = x
        elif z and right[z] == y:
            right[z] = x
        else:
            self.colour[x] = self.colour[y]
            return True
        return False

    def _splay(self, x: int) -> None:
        """Makes ``x`` the root of its splay tree."""
        up, left, right = self.up, self.left, self.right
        y = up[x]
        if not y or (left[y] != x and right[y] != x):
            return
        while True:
            y = up[x]
            z = up[y]
            if z and (left[z] == y or right[z] == y):
                self._rotate(y if (left[z] == y) == (left[y] == x) else x)
            if self._rotate(x):
                return

    def access(self, x: int, colour: int) -> list[tuple[int, int]]:
        """Recolours the path from ``x`` to its root; gives its old segments as (deepest node, old colour)."""
        up, right, paint = self.up, self.right, self.colour
        met, below, at = [], 0, x
        while at:
            self._splay(at)
            old = paint[at]
            if old >= 0:
                met.append((at, old))
            cut = right[at]
            if cut:
                paint[cut] = old  # what is deeper stays a path of its own
            right[at] = below
            below, at = at, up[at]
        # ``below`` is the root of the whole path's splay tree now.
        paint[below] = colour
        return met


def runs_of(words: list[int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a list of words, in order; ``times`` is 2 or more."""
    link, length, prefixes = automaton(words)
    paths = LinkCut([max(0, x) for x in link])
    ends: dict[tuple[int, int], int] = {}
    for i, state in enumerate(prefixes):
        for node, j in paths.access(state, i):
            period = i - j
            whole = length[node] + period
            if whole >= least and whole >= times * period:
                ends[i + 1 - whole, period] = i
    return sorted((start, end + 1 - start, period) for (start, period), end in ends.items())


def pieces(words: list, least: int = LEAST, times: int = TIMES) -> Iterator[tuple[int, int]]:
    """The stretches (from, to) that can hold a run: all their words occur ``times`` times in them."""
    todo = [(0, len(words))]
    while todo:
        start, end = todo.pop()
        if end - start < least:
            continue
        part = words[start:end]
        rare = {word for word, n in Counter(part).items() if n < times}
        if not rare:
            yield start, end
            continue
        at = start
        for i, word in enumerate(part, start):
            if word in rare:
                if i - at >= least:
                    todo.append((at, i))
                at = i + 1
        if end - at >= least:
            todo.append((at, end))


def find_runs(words: list, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a document's words, by start, then period."""
    found = []
    for start, end in pieces(words, least, times):
        number: dict = {}
        part = [number.setdefault(word, len(number)) for word in words[start:end]]
        found += [(start + s, n, q) for s, n, q in runs_of(part, least, times)]
    return sorted(found, key=lambda run: (run[0], run[2]))


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's input: in a tenth of the documents the words repeat from some place on."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    kept, at = [], 0
    for start, end in sorted((s + q, s + n) for s, n, q in runs):
        if start > at:
            kept += words[at:start]
        at = max(at, end)
    return kept + words[at:]


_NUMBERS = ["n_words", "n_runs", "start", "length", "period", "exponent_milli"]


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES,
             prepare: Callable[[object, list[bytes]], list[bytes]] | None = None, with_text: bool = False) -> DataFrame:
    """One row per document: id, n_words, n_runs, the longest run (start, length, period, exponent_milli; NULL
    without runs), runs (start, length, period), runs_sha256, collapsed_sha256 (and collapsed, the kept words).

    The longest run is the first of several, then the one of least period.
    ``prepare`` gives the words to take for a document's id and words.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def of_document(doc_id: object, text: str | None) -> tuple:
        words = (text or "").encode().split()  # bytes split at \\x20 and \\x09-\\x0D alone
        words = prepare(doc_id, words) if prepare else words
        runs = find_runs(words, least, times)
        best = max(runs, key=lambda run: (run[1], -run[0], -run[2]), default=(None, None, None))
        kept = b" ".join(_kept(words, runs) if runs else words)
        listed = "".join([f"{s},{n},{q}\n" for s, n, q in runs])
        return (len(words), len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
                [{"start": s, "length": n, "period": q} for s, n, q in runs], kept.decode() if with_text else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [of_document(i.as_py(), text.as_py()) for i, text in zip(*batch.columns, strict=True)]
            columns = list(zip(*out)) if out else [()] * 10
            types = [pa.int64()] * 6 + [pa.string()] * 2 + [run_type] + [pa.string()] * with_text
            names = [*_NUMBERS, "runs_sha256", "collapsed_sha256", "runs", *["collapsed"] * with_text]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]], names=["id", *names])

    id_type = rows.schema["id"].dataType.simpleString()
    schema = (f"id {id_type}, " + ", ".join(f"{c} long" for c in _NUMBERS) + ", runs_sha256 string, collapsed_sha256 string, "
              "runs array<struct<start: bigint, length: bigint, period: bigint>>" + ", collapsed string" * with_text)
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
