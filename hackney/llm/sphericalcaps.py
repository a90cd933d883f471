"""Near-duplicate embeddings by spherical-cap filters.

A filter is a direction on the unit sphere; a vector passes the filters whose
inner product with it reaches a bound, that is, those in whose cap it lies.
Directions are the words of a random product code: the (randomly rotated)
space is split into ``BLOCKS`` blocks with a codebook each, and a direction is
one codeword of each block. So a vector's filters are list-decoded from its
few block scores, without visiting the directions: the sums over either half
of the blocks are ranked, and the pairs of halves that can reach the bound are
those of small ranks.

A product code's scores spread differently for every vector, so each vector
has its own bound: the score of its ``passed(directions)``-th best direction,
a number that grows with the logarithm of the number of directions. That
number follows the number of vectors, so that unrelated vectors rarely meet in
a cap; both are smooth functions of the count.
Vectors of cosine 0.95 share several caps; the recall against brute force is
measured in the tests. Equal vectors are merged first. What meets in a cap is
verified by its cosine in double precision.

A crowded cap is dealt over chunks of ``CHUNK`` vectors, and each pair of
chunks is a task's unit of work: a matrix product, no list of pairs. A pair
that meets in several caps is counted in the first of them only; what leaves a
unit is a count and a component label for each of its vectors.

Defined cases: vectors that are NULL, empty, zero or hold NULL or non-finite
components link with nothing; vectors of different lengths link with nothing;
a NULL id links with nothing and is kept, its component is NULL; rows that
share an id are one vector, whose links are those of any of them; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import materialise
from hackney.llm.components import components

BLOCKS = 4
STRAY = 0.5      # unrelated vectors that a vector meets in a cap, on average
CHUNK = 512
SEED = 7


def passed(directions: int) -> int:
    """How many filters a vector passes."""
    return 2 * math.ceil(math.log2(directions))


def codewords(vectors: int) -> int:
    """Codewords a block: as many as keep unrelated vectors at ``STRAY`` a cap."""
    words = 16
    while vectors * passed(words ** BLOCKS) > STRAY * words ** BLOCKS:
        words += 1
    return words


@lru_cache(maxsize=4)
def _code(dim: int, words: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rotation and the codebooks for vectors of ``dim`` components."""
    rng = np.random.default_rng([SEED, dim])
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    books = []
    for part in np.array_split(np.arange(dim), BLOCKS):
        book = rng.standard_normal((words, len(part)))
        norms = np.linalg.norm(book, axis=1, keepdims=True)
        # Blocks weigh by their share of the dimensions: a direction has length 1.
        books.append(book / np.where(norms > 0, norms, 1) * math.sqrt(len(part) / dim))
    return rotation, books


@lru_cache(maxsize=4)
def _ranks(wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ranks that the ``wanted`` largest sums of two ranked lists can have."""
    pairs = [(i, j) for i in range(wanted) for j in range(wanted // (i + 1))]
    return tuple(np.array(pairs).T)


def decode(unit: np.ndarray, words: int) -> np.ndarray:
    """Numbers of all filters whose direction's inner product with ``unit`` reaches its bound."""
    rotation, books = _code(len(unit), words)
    wanted = passed(words ** BLOCKS)
    parts = np.array_split(rotation @ unit, BLOCKS)
    a, b, c, d = (book @ part for book, part in zip(books, parts, strict=True))
    halves = [(a[:, None] + b).ravel(), (c[:, None] + d).ravel()]
    best = [np.argpartition(-h, wanted)[:wanted] for h in halves]
    first, second = (top[np.argsort(-h[top], kind="stable")] for h, top in zip(halves, best, strict=True))
    i, j = _ranks(wanted)
    score = halves[0][first[i]] + halves[1][second[j]]
    bound = np.partition(score, -wanted)[-wanted]
    reached = score >= bound
    return np.sort(first[i[reached]] * words ** 2 + second[j[reached]]).astype(np.int64)


def _unit(values) -> np.ndarray | None:
    if values is None or not len(values) or any(v is None for v in values):
        return None
    vector = np.array(values, float)
    if not np.isfinite(vector).all():
        return None
    largest = np.abs(vector).max()
    if not largest:
        return None
    vector = vector / largest  # no overflow or underflow of the norm
    return vector / np.linalg.norm(vector)


def _units(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, key (a digest of the direction; NULL for a vector that cannot link) and unit vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [_unit(v.as_py()) for v in batch.column(1)]
            keys = [None if u is None else hashlib.blake2b(u.tobytes(), digest_size=16).digest() for u in units]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()),
                                              pa.array(units, pa.list_(pa.float64()))], names=["id", "key", "unit"])

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
    return rows.mapInArrow(run, "id long, key binary, unit array<double>")


def _rows_of(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of a list column without NULLs as arrays."""
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy()
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _filters(reps: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _rows_of(batch.column(1))
            # Vectors of different lengths never share a filter number.
            caps = [decode(u, words) * 4096 + len(u) % 4096 for u in units]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(caps, pa.list_(pa.int64()))],
                                             names=["rep", "unit", "copies", "caps"])

    return reps.select("rep", "unit", "copies").mapInArrow(
        run, "rep long, unit array<double>, copies long, caps array<long>")


def _shares_earlier(caps_a: list[np.ndarray], caps_b: list[np.ndarray], cap: int) -> np.ndarray:
    """Whether each pair of filter lists has a common filter before ``cap``."""
    early_a = [c[:np.searchsorted(c, cap)] for c in caps_a]
    early_b = [c[:np.searchsorted(c, cap)] for c in caps_b]
    every = np.unique(np.concatenate([*early_a, *early_b]))
    if not len(every):
        return np.zeros((len(caps_a), len(caps_b)), bool)
    marks = []
    for lists in (early_a, early_b):
        mark = np.zeros((len(lists), len(every)), np.float32)
        for i, c in enumerate(lists):
            mark[i, np.searchsorted(every, c)] = 1
        marks.append(mark)
    return marks[0] @ marks[1].T > 0


def _labels(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The least id each node reaches in a small graph given as a matrix."""
    label = ids.copy()
    while True:
        seen = np.minimum(label, np.where(linked, label, np.iinfo(np.int64).max).min(axis=1))
        if (seen == label).all():
            return label
        label = seen


def _verify(rows: DataFrame, cosine: float) -> DataFrame:
    """Of units of work (cap, i, j; rows sorted by them), for each vector: linked copies, a linked node."""

    def work(cap: int, pair: tuple[int, int], ids, chunk, units, copies, caps) -> list[tuple[int, int, int]]:
        if len({len(u) for u in units}) > 1 or len(ids) < 2:
            return []
        matrix = np.array(units)
        linked = matrix @ matrix.T >= cosine
        np.fill_diagonal(linked, False)
        linked &= ids[:, None] != ids[None, :]
        if pair[0] != pair[1]:
            linked &= chunk[:, None] != chunk[None, :]
        if not linked.any():
            return []
        counted = linked & ~_shares_earlier(caps, caps, cap)
        total = counted @ copies
        least = _labels(linked, ids)
        some = linked.any(axis=1)
        return [(int(r), int(n), int(m)) for r, n, m in zip(ids[some], total[some], least[some], strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_key = [], None

        def finish() -> list[tuple[int, int, int]]:
            if held_key is None:
                return []
            ids, chunk, copies = (np.array([h[k] for h in held], np.int64) for k in (0, 1, 3))
            return work(held_key[0], held_key[1:], ids, chunk, [h[2] for h in held], copies, [h[4] for h in held])

        def batch_of(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                              names=["rep", "linked", "least"])

        for batch in batches:
            out = []
            columns = [_rows_of(c) if pa.types.is_list(c.type) else c.to_pylist() for c in batch.columns]
            for cap, i, j, *row in zip(*columns, strict=True):
                if (cap, i, j) != held_key:
                    out += finish()
                    held, held_key = [], (cap, i, j)
                held.append(row)
            yield batch_of(out)
        yield batch_of(finish())

    return rows.mapInArrow(run, "rep long, linked long, least long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    cosine: float = 0.95) -> DataFrame:
    """One row per vector: id, n_links, component_id (the least id linked, through others too), kept."""
    units = materialise(_units(vectors, id_col, vec_col), "units")
    valid = units.where(F.col("key").isNotNull() & F.col("id").isNotNull())
    classes = valid.groupBy("key").agg(F.min("id").alias("rep"), F.count_distinct("id").alias("copies"))
    classes = materialise(classes, "classes")
    words = codewords(classes.count())
    reps = (valid.join(classes.withColumnRenamed("rep", "id"), ["id", "key"])
            .groupBy("id").agg(F.first("unit").alias("unit"), F.max("copies").alias("copies"))
            .withColumnRenamed("id", "rep"))
    decoded = materialise(_filters(reps, words), "caps")
    members = decoded.select("rep", F.explode("caps").alias("cap"))
    crowds = members.groupBy("cap").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    crowds = materialise(crowds.withColumn("chunks", F.ceil(F.col("n") / CHUNK).cast("int")), "crowds")
    met = members.join(crowds, "cap").withColumn("chunk", F.pmod(F.xxhash64("rep", "cap"), F.col("chunks")).cast("int"))
    # Each chunk meets every chunk of its cap, itself included, in one unit of work.
    units_of_work = met.select("rep", "cap", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("k"))
    units_of_work = units_of_work.select("rep", "cap", "chunk", F.least("chunk", "k").alias("i"),
                                         F.greatest("chunk", "k").alias("j"))
    work = (units_of_work.join(decoded, "rep").select("cap", "i", "j", "rep", "chunk", "unit", "copies", "caps"))
    work = work.repartition("cap", "i", "j").sortWithinPartitions("cap", "i", "j", "rep")
    found = materialise(_verify(work, cosine), "verified")

    same = found.where(F.col("rep") != F.col("least")).select(F.col("rep").alias("a"), F.col("least").alias("b"))
    member_of = valid.select("id", "key").join(classes, "key")
    # Rows of one id with different directions are one vector.
    several = member_of.groupBy("id").agg(F.min("rep").alias("least"), F.max("rep").alias("most"))
    several = several.where(F.col("least") != F.col("most")).select("id", "least")
    joined = (member_of.join(several, "id").where(F.col("rep") != F.col("least"))
              .select(F.col("rep").alias("a"), F.col("least").alias("b")))
    named = components(same.union(joined))
    counts = found.groupBy("rep").agg(F.sum("linked").alias("linked"))
    per_class = (classes.join(counts, "rep", "left").join(named, F.col("rep") == F.col("node"), "left")
                 .select("key", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
                         F.coalesce("component", "rep").alias("component_id")))
    every = units.select("id", F.when(F.col("id").isNotNull(), F.col("key")).alias("key")).join(per_class, "key", "left")
    every = every.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))
    return every.select(F.col("id").alias(id_col), "n_links", "component_id",
                        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
