"""Fixtures and plain-Python references shared by the tests of the training-data operators."""

from __future__ import annotations

import random
import re

# Columns whose names clash with those the operators make for themselves.
CLASH = ["id", "n_tokens", "n_bytes", "length", "component_id", "kept", "slot", "line", "a", "bucket", "sequence_id"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)


def documents(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, lang), with clashing extra columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), *["x"] * len(CLASH)) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def pairs_to_components(nodes, links):
    """The least node each node reaches."""
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def mutate(text, edits, rng, letters="abcé"):
    chars = list(text)
    for _ in range(edits):
        kind, at = rng.randint(0, 2), rng.randint(0, len(chars))
        if kind == 0:
            chars.insert(at, rng.choice(letters))
        elif chars and kind == 1:
            chars.pop(min(at, len(chars) - 1))
        elif chars:
            chars[min(at, len(chars) - 1)] = rng.choice(letters)
    return "".join(chars)


def shingles(text, words):
    """The set of word shingles, as tuples."""
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not found:
        return set()
    return {tuple(found[i:i + words]) for i in range(max(1, len(found) - words + 1))}


def similar(rows, words, percent=80):
    """Component of each id by comparing all pairs."""
    sets = {}
    for i, text in rows:
        sets.setdefault(i, []).append(shingles(text, words))
    links = []
    for a in sets:
        for b in sets:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                links.append((a, b))
    return pairs_to_components(sets, links)


def prose(rng, words):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(words))


def rng(seed):
    return random.Random(seed)
