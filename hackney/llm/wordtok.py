"""Exact word-level evaluation of a tokenizers-library BPE model.

The library spends most of a call on normalisation, splitting and offsets. For
a tokenizer whose normaliser is NFC, white space to one blank and lower case,
and whose split pattern never matches across white space, a text's ids are the
concatenation of the ids of its white-space separated chunks, and a chunk's ids
that of its pre-tokens. So each worker keeps bounded caches from chunk and
pre-token to their ids and asks the library's model only for unseen
pre-tokens. Texts for which this argument is not proven (code points from
U+0250 on, which may need NFC or context-dependent lower case; information
separators, which Python but not the library takes as white space; texts that
hold a special string) and tokenizers of another layout go to the library as a
whole. Tests compare both ways.
"""

from __future__ import annotations

import json
import re

import numpy as np
import regex
from tokenizers import Tokenizer

# Fixed value: the split pattern this module understands.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Entries each cache of a worker holds before it starts anew, and the longest key it stores.
CACHE_ENTRIES = 500_000
CACHED_CHARS = 48

_UNPROVEN = re.compile("[^\x00-ɏ]|[\x1c-\x1f]|İ")


def byte_chars() -> dict[int, str]:
    """Byte value -> the printable character byte-level models use for it."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LATIN1 = {b: c for b, c in byte_chars().items()}


def byte_level(word: str) -> str:
    """``word`` with each UTF-8 byte written as its byte-level character."""
    return word if word.isascii() else word.encode().decode("latin-1").translate(_LATIN1)


def word_layout(spec: dict) -> bool:
    """Whether a tokenizer file has the normaliser and splitter described above."""
    normaliser, splitter = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    steps, splits = normaliser.get("normalizers", []), splitter.get("pretokenizers", [])
    return (
        [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
        and steps[1]["pattern"] == {"Regex": r"\s+"} and steps[1]["content"] == " "
        and [s["type"] for s in splits] == ["Split", "ByteLevel"]
        and splits[0]["pattern"] == {"Regex": SPLIT_PATTERN}
        and splits[0]["behavior"] == "Removed" and splits[0]["invert"] is True
        and splits[1]["add_prefix_space"] is False and splits[1]["use_regex"] is False
        and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
        and spec.get("post_processor") is None
        and all(not t["normalized"] for t in spec.get("added_tokens", [])))


class BoundedCache(dict):
    """A dict that computes missing keys and starts anew (from ``fixed``) when full."""

    def __init__(self, compute, limit: int, fixed: dict | None = None):
        super().__init__(fixed or {})
        self.compute, self.limit, self.fixed = compute, limit, fixed or {}
        self.misses = 0

    def __missing__(self, key):
        value = self.compute(key)
        self.misses += 1
        if len(key) <= CACHED_CHARS:
            if len(self) - len(self.fixed) >= self.limit:
                self.clear()
                self.update(self.fixed)
            self[key] = value
        return value


class WordTokenizer:
    """Ids or lengths of whole texts, equal to the library's ``encode(add_special_tokens=False)``.

    ``lengths`` is an optional table of pre-token lengths that every cache
    starts from (the broadcast tier of the token counter).
    """

    def __init__(self, spec: str, lengths: dict[str, int] | None = None, entries: int = CACHE_ENTRIES):
        layout = json.loads(spec)
        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.by_word = word_layout(layout)
        self._specials = [t["content"] for t in layout.get("added_tokens", [])]
        self._pieces = regex.compile(SPLIT_PATTERN)
        self._ids_of = BoundedCache(self._model_ids, entries)
        self._chunk_ids = BoundedCache(self._join_ids, entries)
        self._length_of = BoundedCache(self._model_length, entries, lengths)
        self._chunk_lengths = BoundedCache(self._add_lengths, entries, lengths)

    def _model_ids(self, piece: str) -> bytes:
        return np.array([t.id for t in self.library.model.tokenize(byte_level(piece))], "<u4").tobytes()

    def _model_length(self, piece: str) -> int:
        return len(self.library.model.tokenize(byte_level(piece)))

    def _join_ids(self, chunk: str) -> bytes:
        if chunk.isalpha():
            return self._ids_of[chunk]
        return b"".join([self._ids_of[p] for p in self._pieces.findall(chunk)])

    def _add_lengths(self, chunk: str) -> int:
        if chunk.isalpha():
            return self._length_of[chunk]
        return sum([self._length_of[p] for p in self._pieces.findall(chunk)])

    def _proven(self, text: str) -> bool:
        return (self.by_word and _UNPROVEN.search(text) is None
                and not any(s in text for s in self._specials))

    def ids(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if self._proven(text):
            return b"".join(map(self._chunk_ids.__getitem__, text.lower().split()))
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def length(self, text: str) -> int:
        if self._proven(text):
            return sum(map(self._chunk_lengths.__getitem__, text.lower().split()))
        return len(self.library.encode(text, add_special_tokens=False).ids)


def frequent_lengths(spec: str) -> dict[str, int]:
    """Pre-token -> number of ids, for the whole words of the tokenizer's vocabulary.

    A BPE vocabulary lists the words that were frequent in its training
    corpus, so it is a table of frequent pre-tokens whose size is bounded by
    the vocabulary, whatever the corpus; it needs no pass over the documents.
    """
    layout = json.loads(spec)
    suffix = layout["model"].get("end_of_word_suffix")
    if not word_layout(layout) or not suffix:
        return {}
    model = Tokenizer.from_str(spec).model
    words = (t[: -len(suffix)] for t in layout["model"]["vocab"] if t.endswith(suffix))
    return {w: len(model.tokenize(w)) for w in words if w.isascii() and w.isalpha() and w == w.lower()}


_WORKER: dict[int, WordTokenizer] = {}


def of_worker(spec: str, lengths: dict[str, int] | None = None) -> WordTokenizer:
    """The tokenizer of this Python worker, whose caches outlive a task."""
    key = hash((spec, bool(lengths)))
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = WordTokenizer(spec, lengths)
    return _WORKER[key]
