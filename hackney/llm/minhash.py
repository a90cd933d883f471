"""Near-duplicate documents by SuperMinHash signatures.

A document's set holds the distinct shingles of ``words`` successive words.
SuperMinHash gives every element a pseudo-random permutation of the ``bands *
rows`` signature slots; a slot keeps the least (rank of the slot in the
element's permutation, random fraction). Ranks are worked through in order for
all elements at once and stop as soon as every slot holds a value of a rank
already done, since later ranks cannot win; large sets stop after the first.
The ranks of one element are correlated, which lowers the variance of the
estimated similarity below that of independent hashes.

Equal sets are merged first, by a 128-bit digest. The others meet in buckets,
one a band; documents whose set similarity is 0.8 share none of 24 bands of 5
rows with probability 7e-5. A crowded bucket is dealt over chunks, and each
pair of chunks is a unit of work, so no task holds a whole bucket and no pairs
are listed by a join. A unit estimates similarities from one byte a slot;
pairs whose estimate is 0.15 below the threshold, four standard deviations of
it, are left out (probability 1e-5 at the threshold). So are pairs that a bound
rules out: histograms of the shingle hashes, about a bucket a shingle, bound
the intersection by the sum of their least counts. In a first round every
document proposes its most similar partner of smaller id; in a second all
remaining pairs of different components are proposed. Proposals are confirmed
on the full sets of the whole texts (as 64-bit shingle hashes), and confirmed
links are joined into components by union-find steps over the distributed list
of links. So every candidate pair is either compared on the full sets or
already in one component.

Defined cases: texts that are NULL or without words have an empty set and link
with nothing; fewer words than a shingle make one shingle; rows that share an
id are one document; a NULL id links with nothing, its component is NULL and it is
kept; an empty table gives no rows; other columns are not read. Very long
texts are shingled whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import materialise
from hackney.llm.components import components

BANDS, ROWS = 24, 5
CHUNK = 512      # documents of a bucket in one half of a unit of work
MARGIN = 0.15    # by which an estimate may miss the threshold
BROADCAST_IDS = 1_000_000  # ids of 8 bytes
FIRST_LOOK = 8   # partners of the best estimates that a first proposal is chosen from
SKETCH_ROWS = 512  # documents whose sets a task holds at once
GROUP_ELEMENTS = 16_384  # shingles that are signed together

_U = np.uint64
_GOLDEN, _M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
# The bytes that separate words, and what the query's lower case maps.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64: a bijective scrambling of 64-bit integers."""
    x = x + _GOLDEN
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


_BYTE = np.where(_SPACE, _U(0), mix(np.arange(256, dtype=_U) + _U(1 << 32)))
_PLACE = mix(np.arange(64, dtype=_U))


def _places(n: int) -> np.ndarray:
    global _PLACE
    if n > len(_PLACE):
        _PLACE = mix(np.arange(2 * n, dtype=_U))
    return _PLACE


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word (multilinear in its bytes, then scrambled)."""
    raw = np.frombuffer(text.lower(), np.uint8)  # bytes.lower() maps A-Z only
    space = _SPACE[raw]
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]])) if len(raw) else np.empty(0, int)
    if not len(starts):
        return np.empty(0, _U)
    lengths = np.diff(np.append(starts, len(raw)))
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, lengths)
    terms = _places(int(lengths.max()))[place] * _BYTE[raw[starts[0]:]]
    return mix(np.add.reduceat(terms, starts - starts[0]))


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    hashes = word_hashes(text or b"")
    if not len(hashes):
        return hashes
    n = max(1, len(hashes) - words + 1)
    total = hashes[:n].copy()
    for k in range(1, min(words, len(hashes))):
        total = mix(total) + hashes[k:k + n]
    return np.unique(mix(total + _U(min(words, len(hashes)))))


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """SuperMinHash signatures (one row of ``slots`` values a set) of non-empty sets."""
    sizes = np.array([len(s) for s in sets])
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    best = np.full((len(sets), slots), np.iinfo(_U).max, _U)
    order = None  # the permutations, made when a second rank is needed
    low = _U(0xFFFFFFFF)
    for rank in range(slots):
        x = mix(elements + _U((rank + 1) * int(_M2) % 2 ** 64))
        # A step of a Fisher-Yates shuffle: of the places from ``rank`` on, one is drawn.
        drawn = rank + ((x & low) * _U(slots - rank) >> _U(32)).astype(np.intp)
        if rank == 0:
            slot = drawn
        else:
            here = np.arange(len(elements))
            if order is None:
                order = np.tile(np.arange(slots, dtype=np.uint16), (len(elements), 1))
                order[here, ((mix(elements + _M2) & low) * _U(slots) >> _U(32)).astype(np.intp)] = 0
            slot = order[here, drawn]
            order[here, drawn] = order[:, rank]
        np.minimum.at(best, (owner, slot), _U(rank << 32) | (x >> _U(32)))
        going = best.max(axis=1) >= _U((rank + 1) << 32)
        if not going.any():
            break
        still = going[owner]
        if not still.all():
            elements, owner = elements[still], owner[still]
            order = order[still] if order is not None else None
    return best


def band_keys(best: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each signature, the band's number hashed in."""
    parts = best.reshape(len(best), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=_U), (len(best), bands))
    for k in range(rows):
        key = mix(key * _M1 + parts[:, :, k])
    return key


def _grouped(sets: list[np.ndarray]) -> Iterator[list[int]]:
    group, size = [], 0
    for i, s in enumerate(sets):
        if not len(s):
            continue
        if group and size + len(s) > GROUP_ELEMENTS:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(s)
    if group:
        yield group


def histogram(shingles: np.ndarray) -> np.ndarray:
    """Counts of a set's hashes by their low bits, in the least power of two of buckets that is its size."""
    buckets = 1 << max(0, len(shingles) - 1).bit_length()
    counts = np.bincount((shingles & _U(buckets - 1)).astype(np.intp), minlength=buckets)
    return np.minimum(counts, 255).astype(np.uint8)


def fold(counts: np.ndarray, buckets: int) -> np.ndarray:
    """The histogram of the same hashes in fewer buckets."""
    return counts if len(counts) == buckets else counts.reshape(-1, buckets).sum(axis=0, dtype=np.uint16)


def intersection_bounds(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Upper bounds of the intersections of a set with others, from their histograms."""
    out = np.empty(len(others), np.int64)
    levels = np.array([min(len(own), len(o)) for o in others], np.int64)
    for buckets in np.unique(levels).tolist():
        at = np.flatnonzero(levels == buckets)
        stacked = np.stack([fold(others[i], buckets) for i in at])
        out[at] = np.minimum(stacked, fold(own, buckets)).sum(axis=1, dtype=np.int64)
    return out


def sketch(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int) -> DataFrame:
    """id, n_shingles, digest of the set (two longs), band keys, a byte a slot, histogram (NULL for empty sets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, SKETCH_ROWS) for b in batches for at in range(0, b.num_rows, SKETCH_ROWS)):
            sets = [shingle_set(text.as_py(), words) for text in batch.column(1)]
            keys: list = [None] * len(sets)
            slots: list = [None] * len(sets)
            counts = [histogram(s).tobytes() if len(s) else None for s in sets]
            digests: list = [(None, None)] * len(sets)
            for group in _grouped(sets):
                best = signatures([sets[i] for i in group], bands * rows)
                for i, k, own in zip(group, band_keys(best, bands, rows), best.astype(np.uint8), strict=True):
                    keys[i], slots[i] = k.view(np.int64), own.tobytes()
                    digests[i] = np.frombuffer(hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest(), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(slots, pa.binary()), pa.array(counts, pa.binary())],
                names=["id", "n_shingles", "d1", "d2", "bands", "slots", "counts"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return source.mapInArrow(run, "id long, n_shingles long, d1 long, d2 long, bands array<long>, slots binary, "
                                  "counts binary")


def _proposals(ids, component, sizes, slots, counts, bands, chunk, bucket: int, pair: tuple[int, int], percent: int,
               every: bool) -> np.ndarray:
    """Pairs of places in a unit of work that are worth comparing."""
    def possible(v: int, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of ``u`` that the bound allows as partners of v, and the similarities it allows."""
        both = intersection_bounds(counts[v], [counts[i] for i in u])
        either = sizes[u] + sizes[v] - both
        ok = 100 * both >= percent * either
        return u[ok], (both / either)[ok]

    def first_common(v: int, u: np.ndarray) -> np.ndarray:
        """Those of ``u`` that v meets in no bucket before this one: a pair counts once."""
        place = int(np.flatnonzero(bands[v] == bucket)[0])
        return u[~(bands[u, :place] == bands[v, :place]).any(axis=1)]

    order = np.argsort(ids, kind="stable")
    found = []
    least = (percent / 100 - MARGIN) * slots.shape[1]
    for row, v in enumerate(order[1:], 1):  # against those of smaller id
        u = order[:row]
        ok = (component[u] != component[v]) & (np.minimum(sizes[u], sizes[v]) * 100
                                               >= np.maximum(sizes[u], sizes[v]) * percent)
        if pair[0] != pair[1]:
            ok &= chunk[u] != chunk[v]
        u = u[ok]
        if not len(u):
            continue
        agree = (slots[u] == slots[v]).sum(axis=1)
        u, agree = u[agree >= least], agree[agree >= least]
        if every:
            u = first_common(v, u)
        else:
            u = u[np.argsort(-agree, kind="stable")[:FIRST_LOOK]]
        if len(u):
            u, similar = possible(v, u)
        if len(u) and not every:
            # The best of all its buckets comes through: it is the best of the first it is met in.
            u = first_common(v, u[[np.argmax(similar)]])
        found += [(v, w) for w in u]
    return np.array(found, np.intp).reshape(-1, 2)


def _propose(work: DataFrame, percent: int, every: bool) -> DataFrame:
    """Pairs (a, b) with a > b to compare; rows of work come sorted by unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_key = [], None

        def finish() -> list[np.ndarray]:
            if held_key is None or len(held) < 2:
                return []
            ids, component, sizes, chunk = (np.array([h[k] for h in held], np.int64) for k in range(4))
            slots = np.array([np.frombuffer(h[4], np.uint8) for h in held])
            counts = [np.frombuffer(h[5], np.uint8) for h in held]
            bands = np.array([h[6] for h in held], np.int64)
            pairs = _proposals(ids, component, sizes, slots, counts, bands, chunk, held_key[0], held_key[1:], percent, every)
            return [ids[pairs]]

        def batch_of(found: list[np.ndarray]) -> pa.RecordBatch:
            pairs = np.concatenate(found) if found else np.empty((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            out = []
            for bucket, i, j, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (bucket, i, j) != held_key:
                    out += finish()
                    held, held_key = [], (bucket, i, j)
                held.append(row)
            yield batch_of(out)
        yield batch_of(finish())

    columns = ["bucket", "i", "j", "rep", "component", "size", "chunk", "slots", "counts", "bands"]
    units = work.select(*columns).repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "rep")
    return units.mapInArrow(run, "a long, b long").distinct()


def _compare(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """Of rows (a, b, text_a, text_b), the pairs (a, b) and whether their sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple = (None, None)
        for batch in batches:
            same = []
            a_ids, b_ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for b, text_a, text_b in zip(b_ids, batch.column(2), batch.column(3), strict=True):
                if known[0] != b:  # rows come sorted by b
                    known = b, text_b.as_py(), shingle_set(text_b.as_py(), words)
                other = known[2] if known[1] == text_b.as_py() else shingle_set(text_b.as_py(), words)
                own = shingle_set(text_a.as_py(), words)
                both = len(np.intersect1d(own, other, assume_unique=True))
                same.append(bool(both) and 100 * both >= percent * (len(own) + len(other) - both))
            yield pa.RecordBatch.from_arrays([pa.array(a_ids, pa.int64()), pa.array(b_ids, pa.int64()),
                                              pa.array(same, pa.bool_())], names=["a", "b", "same"])

    return rows.mapInArrow(run, "a long, b long, same boolean")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: id, n_shingles, component_id (the least id it is linked with), kept."""
    signed = materialise(sketch(docs, id_col, text_col, words, bands, rows), "signatures")
    sets = signed.where(F.col("bands").isNotNull() & F.col("id").isNotNull())
    # Equal sets: one representative each, so copies never reach the buckets.
    # Written, so that the join below is one that adaptive execution can split at a hot digest.
    classes = materialise(sets.groupBy("d1", "d2").agg(F.min("id").alias("rep")), "classes")
    placed = materialise(sets.select("id", "n_shingles", "d1", "d2").join(classes, ["d1", "d2"])
                         .select("id", "n_shingles", "rep"), "placed")
    # Rows of one id with different sets are one document: link their classes.
    several = (placed.groupBy("id").agg(F.min("rep").alias("least"), F.max("rep").alias("most"))
               .where(F.col("least") != F.col("most")).select("id", "least"))
    links = (placed.join(several, "id").where(F.col("rep") != F.col("least"))
             .select(F.col("rep").alias("a"), F.col("least").alias("b")))
    reps = sets.join(classes.withColumnRenamed("rep", "id"), ["id", "d1", "d2"]).select(
        F.col("id").alias("rep"), F.col("n_shingles").alias("size"), "slots", "counts", "bands")
    members = reps.select("rep", F.explode("bands").alias("bucket"))
    crowds = members.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    crowds = crowds.select("bucket", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    met = members.join(crowds, "bucket").withColumn(
        "chunk", F.pmod(F.xxhash64("rep", "bucket"), F.col("chunks")).cast("int"))
    # Each chunk meets every chunk of its bucket, itself included, in one unit of work.
    met = met.select("rep", "bucket", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("k"))
    met = met.select("rep", "bucket", "chunk", F.least("chunk", "k").alias("i"), F.greatest("chunk", "k").alias("j"))
    work = materialise(met.join(reps, "rep"), "work")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    found = _link(work, texts, links, words, percent)

    named = placed.join(found, F.col("rep") == F.col("node"), "left")
    named = named.select("id", "n_shingles", F.coalesce("component", "rep").alias("component"))
    alone = (signed.where(F.col("bands").isNull() | F.col("id").isNull())
             .select("id", "n_shingles", F.col("id").alias("component")))
    return named.union(alone).select(
        F.col("id").alias(id_col), "n_shingles", F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


def _texts_of(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The texts (id, text) that pairs (a, b) name.

    A checked number of ids is broadcast, so that only their texts leave the
    scan; more are joined by shuffle, with the same result.
    """
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    ids = materialise(ids, "ids")
    return texts.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")


def _link(work: DataFrame, texts: DataFrame, links: DataFrame, words: int, percent: int) -> DataFrame:
    """Components (node, component) of ``links`` and of all links confirmed among the rows of work."""
    found = None
    for every in (False, True):
        if found is None:
            named = work.withColumn("component", F.col("rep"))
        else:
            named = (work.join(found, F.col("rep") == F.col("node"), "left")
                     .withColumn("component", F.coalesce("component", "rep")))
        pairs = materialise(_propose(named, percent, every), "pairs")
        needed = materialise(_texts_of(pairs, texts), "texts")
        sides = (pairs.join(needed.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
                 .join(needed.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
                 .select("a", "b", "text_a", "text_b"))
        confirmed = _compare(sides, words, percent).where("same").select("a", "b")
        known = links if found is None else found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = components(known.union(confirmed))
    return found
