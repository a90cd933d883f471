"""Alignment of two tokenizers' ids over the same bytes, with corpus-wide link counts.

Each text is encoded twice: space+text by a byte-level BPE (A), the text by a
sentencepiece model that adds the space itself (B). The cumulative byte ends of
both id lists are kept in dictionaries from end to index; the sorted common
keys of the two cut both lists into groups, and the links of a group are all
pairs of an A and a B token whose bytes overlap, expanded per slice (a slice of
m and k ids has m + k - 1 of them).

Neither tokenizer merges anything across a blank that stands between two
characters which are no white space, so ids, ends and groups of a text are those
of its units (a blank with what follows, up to the next such blank). That is
checked for the two files when they are loaded, and per unit by comparing
the bytes its ids stand for with its own; workers keep a bounded cache of aligned
units. For files that fail the check a text is one unit.

An id pair's count is the number of documents that hold it linked. One pass
encodes and aligns; it writes each document's distinct pairs with how often it
holds them. These are counted with map-side combine, and meet their counts in a
join whose sums are combined per document before they are shuffled. While the
table of counts has at most ``BROADCAST_PAIRS`` rows (counted first) it is
broadcast, and beyond that the join runs by shuffle, with the same result.

Defined cases: NULL and empty texts, and texts whose ids stand for other bytes
than space+text (for instance those with U+2581, which B cannot tell from a
blank), have no tokens: all numbers 0 and ``groups_sha256`` the empty text.
Rows that repeat an id, or have none, are documents of their own; an empty
table gives no rows; other columns are not read. Texts are never cut.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hackney.llm import spcodec
from hackney.llm.common import materialise, ship_package
from hackney.llm.wordtok import byte_chars

MARKER = spcodec.MARKER
#: Rows (a pair, its count and a flag) of the table of counts up to which it is broadcast.
BROADCAST_PAIRS = 1_000_000
#: Units each of a worker's two cache generations holds; longer ones are not kept.
CACHE_UNITS, CACHED_CHARS = 150_000, 64
#: Groups (their text and links) the cache of them holds, and the most tokens of one that is kept.
CACHE_GROUPS, CACHED_TOKENS = 200_000, 16
#: Characters of the texts that are taken up at once.
BLOCK_CHARS = 2_000_000

_SHIFT = 32  # a pair is (A id << 32) + B id
_CUT = re.compile(r"(?<=\S) (?=\S)")
_ODD = re.compile(r"\s |\s\Z| \s|\A\s")  # a blank beside white space, or white space at an end


def align(ends_a: list[int], ends_b: list[int]) -> list[tuple[int, int, int, int]]:
    """The groups of two token lists over the same bytes, as slices (a from, a to, b from, b to)."""
    index_a = {end: i for i, end in enumerate(ends_a, 1)}
    index_b = {end: i for i, end in enumerate(ends_b, 1)}
    groups, a, b = [], 0, 0
    for end in sorted(index_a.keys() & index_b.keys()):
        groups.append((a, index_a[end], b, index_b[end]))
        a, b = index_a[end], index_b[end]
    return groups


def links(ends_a: list[int], ends_b: list[int], group: tuple[int, int, int, int]) -> list[tuple[int, int]]:
    """The index pairs of a group whose bytes overlap."""
    a, a_to, b, b_to = group
    out = []
    while a < a_to and b < b_to:
        out.append((a, b))
        if ends_a[a] < ends_b[b]:
            a += 1
        elif ends_b[b] < ends_a[a]:
            b += 1
        else:
            a, b = a + 1, b + 1
    return out


class Aligned(NamedTuple):
    """A unit's numbers of tokens and groups, its groups as text, its links as pairs, and its ids if they
    stand for other bytes."""

    n_a: int
    n_b: int
    groups: int
    text: str
    pairs: bytes
    wrong: tuple[list[int], list[int]] | None = None


class Aligner:
    """Aligns units of text; ``units`` cuts a text into them."""

    def __init__(self, json_spec: str, model: bytes):
        layout, parsed = json.loads(json_spec), spcodec.parse(model)
        self.first = Tokenizer.from_str(json_spec)
        self.first.encode_special_tokens = True
        self.first.no_truncation()
        self.first.no_padding()
        self.second = sentencepiece.SentencePieceProcessor(model_proto=model)
        inner = re.compile(f"[^{MARKER}]{MARKER}")
        split = layout.get("pre_tokenizer") or {}
        self.by_unit = (layout.get("normalizer") is None and split.get("type") == "ByteLevel"
                        and split["use_regex"] and not split["add_prefix_space"]
                        and parsed.kind == spcodec.BPE and parsed.dummy_prefix and parsed.escape_blanks
                        and not parsed.charsmap and not parsed.merge_blanks
                        and not any(kind == spcodec.USER_DEFINED or (kind != spcodec.CONTROL and inner.search(piece))
                                    for piece, _, kind in parsed.pieces))
        byte_of = {c: b for b, c in byte_chars().items()}
        size = max(self.first.get_vocab().values()) + 1
        self.bytes_a = [b""] * size
        for token, i in self.first.get_vocab().items():
            self.bytes_a[i] = (bytes([byte_of[c] for c in token]) if all(c in byte_of for c in token) else token.encode())
        self.bytes_b = [bytes([int(piece[3:5], 16)]) if kind == spcodec.BYTE else piece.replace(MARKER, " ").encode()
                        for piece, _, kind in parsed.pieces]
        self.sizes_a, self.sizes_b = list(map(len, self.bytes_a)), list(map(len, self.bytes_b))
        self._young: dict[str, Aligned] = {}
        self._old: dict[str, Aligned] = {}
        self._groups: dict[int | tuple, tuple[str, bytes]] = {}

    def units(self, text: str) -> list[str]:
        """Space+text in units; each is without its leading blank."""
        if not self.by_unit:
            return [text]
        return text.split(" ") if _ODD.search(text) is None else _CUT.split(text)

    def _align(self, unit: str, a: list[int], b: list[int]) -> Aligned:
        whole = b" " + unit.encode()
        if (b"".join(map(self.bytes_a.__getitem__, a)) != whole
                or b"".join(map(self.bytes_b.__getitem__, b)) != whole):
            return Aligned(len(a), len(b), 0, "", b"", (a, b))
        return self._cut(a, b)

    def _cut(self, a: list[int], b: list[int]) -> Aligned:
        ends_a = list(accumulate(map(self.sizes_a.__getitem__, a)))
        ends_b = list(accumulate(map(self.sizes_b.__getitem__, b)))
        groups = align(ends_a, ends_b)
        known = self._groups
        texts, pairs = [], []
        for i, j, k, m in groups:
            key = (a[i] << _SHIFT) + b[k] if j - i == 1 == m - k else (tuple(a[i:j]), tuple(b[k:m]))
            entry = known.get(key)
            if entry is None:
                entry = (f"{','.join(map(str, a[i:j]))}|{','.join(map(str, b[k:m]))}", np.array(
                    [(a[x] << _SHIFT) + b[y] for x, y in links(ends_a, ends_b, (i, j, k, m))], "<i8").tobytes())
                if j - i + m - k <= CACHED_TOKENS:
                    if len(known) >= CACHE_GROUPS:
                        known.clear()
                    known[key] = entry
            texts.append(entry[0])
            pairs.append(entry[1])
        return Aligned(len(a), len(b), len(groups), ";".join(texts), b"".join(pairs))

    def lookup(self, wanted: set[str]) -> dict[str, Aligned]:
        """Every wanted unit aligned; those not in the cache are encoded in one call of each library."""
        out, missing = {}, []
        for unit in wanted:
            found = self._young.get(unit)
            if found is None:
                found = self._old.get(unit)
                if found is None:
                    missing.append(unit)
                    continue
                self._young[unit] = found
            out[unit] = found
        if missing:
            first = self.first.encode_batch_fast([" " + u for u in missing], add_special_tokens=False)
            second = self.second.encode(missing, num_threads=1)
            for unit, a, b in zip(missing, first, second, strict=True):
                out[unit] = found = self._align(unit, a.ids, b)
                if len(unit) <= CACHED_CHARS:
                    self._young[unit] = found
        if len(self._young) > CACHE_UNITS:  # units that are in use come back from the old generation
            self._old, self._young = self._young, {}
        return out

    def texts(self, texts: list[str | None]) -> Iterator[list[Aligned]]:
        """The aligned units of each text, in order; none for a text without tokens."""
        at = 0
        while at < len(texts):
            to, chars = at, 0
            while to < len(texts) and (to == at or chars + len(texts[to] or "") <= BLOCK_CHARS):
                chars += len(texts[to] or "")
                to += 1
            cut = [self.units(t) if t else [] for t in texts[at:to]]
            known = self.lookup({u for units in cut for u in units})
            for text, units in zip(texts[at:to], cut, strict=True):
                found = [known[u] for u in units]
                if any([x.wrong for x in found]):
                    found = self._whole(text)
                yield found
            at = to

    def _whole(self, text: str) -> list[Aligned]:
        """A text with a unit whose ids stand for other bytes: only the joined bytes decide."""
        a = self.first.encode(" " + text, add_special_tokens=False).ids
        found = self._align(text, a, self.second.encode(text))
        return [] if found.wrong else [found]


_WORKER: dict[int, Aligner] = {}


def of_worker(spec: str, model: bytes) -> Aligner:
    key = hash((spec, model))
    if key not in _WORKER:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        _WORKER.clear()
        _WORKER[key] = Aligner(spec, model)
    return _WORKER[key]


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def documents(docs: DataFrame, json_path: str, model_path: str, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, groups_sha256, pairs (distinct), times."""
    ship_package(docs.sparkSession)
    files = docs.sparkSession.sparkContext.broadcast((_read(json_path).decode(), _read(model_path)))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = of_worker(*files.value)
        for batch in batches:
            numbers, digests, pairs, times = [], [], [], []
            for found in aligner.texts(batch.column(1).to_pylist()):
                linked = np.frombuffer(b"".join([x.pairs for x in found]), "<i8")
                distinct, n = np.unique(linked, return_counts=True)
                text = ";".join([x.text for x in found])
                numbers.append((sum([x.n_a for x in found]), sum([x.n_b for x in found]),
                                sum([x.groups for x in found]), len(linked)))
                digests.append(hashlib.sha256(text.encode()).hexdigest() if found else "")
                pairs.append(distinct)
                times.append(n.astype("i4"))
            columns = np.array(numbers, "i8").reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(columns[:, i]) for i in range(4)], pa.array(digests, pa.string()),
                 pa.array(pairs, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int32()))],
                names=["id", *_NUMBERS, "groups_sha256", "pairs", "times"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, " + ", ".join(f"{c} long" for c in _NUMBERS)
                           + ", groups_sha256 string, pairs array<bigint>, times array<int>")


def link_counts(documents: DataFrame) -> DataFrame:
    """pair, n (documents that hold it linked), best (whether n is the highest of its A id)."""
    counted = documents.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    # An A id has no more pairs than B has ids.
    same_a = Window.partitionBy(F.shiftright("pair", _SHIFT))
    return counted.select("pair", "n", (F.col("n") == F.max("n").over(same_a)).alias("best"))


def digests(docs: DataFrame, json_path: str, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best``: links whose count is the highest of their A id; ``count_sum``:
    the sum of all links' counts.
    """
    aligned = documents(docs, json_path, model_path, id_col, text_col)
    # A number per row, fixed by writing it, tells documents that share an id apart.
    aligned = materialise(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = materialise(link_counts(aligned), "link-counts")
    if counts.count() <= BROADCAST_PAIRS:  # a checked size; else by shuffle, with the same result
        counts = F.broadcast(counts)
    held = aligned.select("row", F.inline(F.arrays_zip("pairs", "times")))
    sums = held.join(counts, F.col("pairs") == F.col("pair")).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return aligned.drop("pairs", "times").join(sums, "row", "left").select(
        F.col("id").alias(id_col), *_NUMBERS, zero("n_best"), zero("count_sum"), "groups_sha256")
