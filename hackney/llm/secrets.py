"""Secret scans by a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived: for
each part of the expression, the strings it can be (if they are few), those it can
begin and end with, and a query that any text it matches satisfies; parts in a
row are joined by AND, with the trigrams across their seams, alternatives by OR.
Documents are taken up in blocks; of each block an inverted index is made of
the trigrams that some query names (their number is bounded by the rules), over
UTF-8 with A-Z in lower case. A rule's candidates are found by intersecting and
uniting postings, and verified by the expression itself over their whole texts.
A rule from which no mandatory trigram follows scans all texts. A block's
postings never leave its task: there is no shuffle, and the index's size follows
the block's.

The base kinds are assign, access and hex; ``RULES`` adds well-known forms of
keys, which never change the base spans. Spans are code points, end exclusive.

Defined cases: a NULL text is empty and has no spans; the digest of no spans is
that of the empty text; a NULL id is kept; rows that repeat an id are documents
of their own; an empty table gives no rows; other columns are not read. Texts
are processed whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import ship_package

#: Bytes of text of a block, and positions looked at together.
BLOCK_BYTES, PART = 4_000_000, 1_000_000
#: Alternatives a set of strings may have, and characters one class may stand for, before they count as any.
MAX_STRINGS, MAX_CLASS = 16, 10


# -- trigram queries ---------------------------------------------------------------
# A query is True (every text), a trigram (bytes), or ("and" | "or", queries).


def both(*queries):
    parts = {q for q in queries if q is not True}
    return True if not parts else parts.pop() if len(parts) == 1 else ("and", frozenset(parts))


def either(*queries):
    parts = set(queries)
    return True if True in parts or not parts else parts.pop() if len(parts) == 1 else ("or", frozenset(parts))


def trigrams(strings) -> object:
    """The query of texts that hold one of the strings."""
    return either(*[both(*[s[i:i + 3] for i in range(len(s) - 2)]) for s in strings])


@dataclass(frozen=True)
class Part:
    """What a part of an expression matches: ``exact`` strings (None if they are many), its first and
    last characters, and what any text that holds a match satisfies."""

    exact: frozenset | None
    first: frozenset
    last: frozenset
    query: object = True


EMPTY = frozenset([b""])
ANY = Part(None, EMPTY, EMPTY)


def _few(strings: set, keep) -> frozenset:
    """The strings cut by ``keep`` until there are few of them; the empty one says nothing."""
    for n in (3, 2, 1):
        strings = {keep(s, n) for s in strings}
        if len(strings) <= MAX_STRINGS:
            return frozenset(strings)
    return EMPTY


def _head(strings) -> frozenset:
    return _few(set(strings), lambda s, n: s[:n])


def _tail(strings) -> frozenset:
    return _few(set(strings), lambda s, n: s[-n:])


def _settled(part: Part) -> Part:
    """``part`` without exact strings, which its query tells of instead."""
    if part.exact is None:
        return part
    return Part(None, _head(part.exact), _tail(part.exact), both(part.query, trigrams(part.exact)))


def _joined(a: Part, b: Part) -> Part:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MAX_STRINGS:
        return Part(frozenset(x + y for x in a.exact for y in b.exact), EMPTY, EMPTY, both(a.query, b.query))
    first = _head(x + y for x in a.exact for y in _settled(b).first) if a.exact is not None else a.first
    last = _tail(x + y for x in _settled(a).last for y in b.exact) if b.exact is not None else b.last
    a, b = _settled(a), _settled(b)
    seam = trigrams(x + y for x in a.last for y in b.first)
    return Part(None, first, last, both(a.query, b.query, seam))


def _alternative(a: Part, b: Part) -> Part:
    if a.exact is not None and b.exact is not None and len(a.exact | b.exact) <= MAX_STRINGS:
        return Part(a.exact | b.exact, EMPTY, EMPTY, either(a.query, b.query))
    a, b = _settled(a), _settled(b)
    return Part(None, _head(a.first | b.first), _tail(a.last | b.last), either(a.query, b.query))


#: Letters that have cases beyond ASCII (long s, Kelvin sign, dotted and dotless i).
_MORE_CASES = frozenset("iskISK")


def _character(code: int, flags: int) -> frozenset | None:
    """How a character stands in the index; None if not all of its cases are lower-cased there."""
    beyond = code >= 128 or (chr(code) in _MORE_CASES and not flags & re.A)
    return None if flags & re.I and beyond else frozenset([chr(code).lower().encode() if code < 128 else chr(code).encode()])


def _class(items, flags: int) -> Part:
    found: set = set()
    for kind, value in items:
        codes = [value] if kind.name == "LITERAL" else range(value[0], value[1] + 1) if kind.name == "RANGE" else None
        if codes is None or len(codes) > 2 * MAX_CLASS:
            return ANY
        for code in codes:
            one = _character(code, flags)
            if one is None:
                return ANY
            found |= one
    return Part(frozenset(found), EMPTY, EMPTY) if len(found) <= MAX_CLASS else ANY


def _analysed(tree, flags: int) -> Part:
    part = Part(EMPTY, EMPTY, EMPTY)
    for op, value in tree:
        name = op.name
        if name == "LITERAL":
            one = _character(value, flags)
            step = ANY if one is None else Part(one, EMPTY, EMPTY)
        elif name == "IN":
            step = _class(value, flags)
        elif name == "BRANCH":
            steps = [_analysed(t, flags) for t in value[1]]
            step = steps[0]
            for other in steps[1:]:
                step = _alternative(step, other)
        elif name == "SUBPATTERN":
            _, added, removed, inner = value
            step = _analysed(inner, (flags | added) & ~removed)
        elif name == "ATOMIC_GROUP":
            step = _analysed(value, flags)
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, inner = value
            once = _analysed(inner, flags)
            if (least, most) == (0, 1):
                step = _alternative(once, Part(EMPTY, EMPTY, EMPTY))
            else:
                step = ANY if least == 0 else once
                for _ in range(min(least, 3) - 1):
                    step = _joined(step, once)
                if least and (most != least or least > 3):
                    step = Part(None, _settled(step).first, _settled(once).last, _settled(step).query)
        elif name in ("AT", "ASSERT", "ASSERT_NOT"):
            continue  # of no width
        else:
            step = ANY
        part = _joined(part, step)
    return part


def trigram_query(pattern: str, flags: int = 0):
    """The query that every text satisfies in which ``pattern`` finds something; True if none follows."""
    from re import _parser

    tree = _parser.parse(pattern, flags)
    return _settled(_analysed(tree, tree.state.flags)).query


def named(query) -> set:
    """The trigrams of a query."""
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(named, query[1]))


# -- rules ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A kind of span: an expression, and the least length of a group of it (0: the whole match)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0

    @cached_property
    def regex(self) -> re.Pattern:
        return re.compile(self.pattern)

    @cached_property
    def query(self):
        return trigram_query(self.pattern)

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Leftmost matches that do not overlap; those that are too short are left out afterwards."""
        return [m.span() for m in self.regex.finditer(text) if m.end(self.group) - m.start(self.group) >= self.least]


# Fixed values of the contract: the base kinds, in their order.
BASE = (
    Rule("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # Runs of 24 and more are the same spans as those of + that are long enough, found without listing the short ones.
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
# Well-known public forms of keys. A look-behind starts a match at the start of its run of
# characters only, so that no text is scanned more than once.
RULES = BASE + (
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----"),
    Rule("github", r"(?<![A-Za-z0-9])gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"(?<![A-Za-z0-9_-])AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("url", r"(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]*://[^\s/:@]+:[^\s/@]+@"),
)


# -- the index of a block -------------------------------------------------------------


class Scanner:
    """Finds the spans of the rules in blocks of texts."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        wanted = sorted(set().union(*[named(r.query) for r in rules]))
        self.codes = np.array([t[0] << 16 | t[1] << 8 | t[2] for t in wanted], np.int32)
        self.wanted = wanted
        self.starts = np.zeros(1 << 16, bool)  # first two bytes of a wanted trigram
        self.starts[self.codes >> 8] = True
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32

    def postings(self, data: np.ndarray, ends: np.ndarray) -> dict[bytes, np.ndarray]:
        """Trigram -> the documents (numbers in the block, in order) whose bytes hold it.

        ``ends`` are the documents' ends in ``data``.
        """
        found_at, found = [], []
        for at in range(0, max(0, len(data) - 2), PART):
            part = self.lower[data[at:at + PART + 2]].astype(np.int32)
            pairs = part[:-2] << 8 | part[1:-1]
            places = np.flatnonzero(self.starts[pairs])
            codes = pairs[places] << 8 | part[2:][places]
            which = np.searchsorted(self.codes, codes)
            which[which == len(self.codes)] = 0
            hit = self.codes[which] == codes if len(self.codes) else np.zeros(0, bool)
            found_at.append(places[hit] + at)
            found.append(which[hit])
        if not found:
            return {}
        places, which = np.concatenate(found_at), np.concatenate(found)
        docs = np.searchsorted(ends, places, "right")
        inside = places + 3 <= ends[docs]  # not across two documents
        keys = np.unique(which[inside].astype(np.int64) * len(ends) + docs[inside])
        cuts = np.searchsorted(keys, np.arange(len(self.wanted) + 1) * len(ends))
        return {t: keys[cuts[i]:cuts[i + 1]] % len(ends) for i, t in enumerate(self.wanted)}

    def candidates(self, query, postings: dict[bytes, np.ndarray], n: int) -> np.ndarray:
        """The documents of a block of ``n`` that satisfy ``query``."""
        if query is True:
            return np.arange(n)
        if isinstance(query, bytes):
            return postings.get(query, np.zeros(0, np.int64))
        parts = sorted((self.candidates(q, postings, n) for q in query[1]), key=len)
        out = parts[0]
        for other in parts[1:]:
            out = (np.intersect1d if query[0] == "and" else np.union1d)(out, other)
        return out

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Of each text, its spans as (start, place of the rule, end), in order."""
        raw = [t.encode() for t in texts]
        postings = self.postings(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw]))
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for number, rule in enumerate(self.rules):
            for doc in self.candidates(rule.query, postings, len(texts)).tolist():
                out[doc] += [(start, number, end) for start, end in rule.spans(texts[doc])]
        return [sorted(spans) for spans in out]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: id, n_<kind> of each base rule, base_sha256, spans (kind:start:end, comma-joined)."""
    ship_package(docs.sparkSession)
    base = [i for i, r in enumerate(rules) if r in BASE]
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    names = ["id", *[f"n_{rules[i].kind}" for i in base], "base_sha256", "spans"]

    def blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes = np.cumsum(np.diff(np.frombuffer(batch.column(1).buffers()[1], np.int32)[
            batch.column(1).offset:batch.column(1).offset + len(batch) + 1].astype(np.int64)))
        at = 0
        while at < len(batch):
            before = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, before + BLOCK_BYTES, "right")))
            yield batch.slice(at, to - at)
            at = to

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            for block in blocks(batch):
                found = scanner.scan(block.column(1).to_pylist())
                show = lambda spans: ",".join([f"{rules[k].kind}:{s}:{e}" for s, k, e in spans])
                counts = [pa.array([sum([k == i for _, k, _ in spans]) for spans in found], pa.int64()) for i in base]
                digest = [hashlib.sha256(show([x for x in spans if x[1] in base]).encode()).hexdigest() for spans in found]
                yield pa.RecordBatch.from_arrays(
                    [block.column(0), *counts, pa.array(digest, pa.string()),
                     pa.array([show(spans) for spans in found], pa.string())], names=names)

    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, " + ", ".join(f"n_{rules[i].kind} long" for i in base) + ", base_sha256 string, spans string"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
