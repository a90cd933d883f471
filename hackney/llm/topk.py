"""Exact top-k by inner product: no-random-access aggregation over sorted lists.

The rows are dealt into blocks by a hash of their id and the queries into
groups; a unit of work is one group against one block, and its size is bounded
whatever the table's. A block keeps, for each vector component, the list of
its rows sorted by that component. A query reads all lists in step, from the
end that favours the sign of its own component; the queries of a group read
together, so that what they have read adds up in matrix products. What has
been read of a row is its known part; the rest of its score is at most what the
lists' current entries, and at least what their last entries, would add. A
query stops reading when at most ``SHORTLIST`` rows have an upper bound that
reaches the k-th best lower bound (or the k-th best final score from blocks
that this task has finished): no other row can qualify. The final scores of the
rows left are then resolved, in integers. The best k of each unit are merged
into the best k of a query.

Defined cases: vectors that are NULL, empty or hold NULL or non-finite components
take no part, nor do NULL ids; vectors of different lengths do not meet; of
rows that share an id one counts, the least vector by its components; a query
never finds its own id; ties go to the smaller id; a query with fewer than k
candidates gets all; an empty table gives no rows; other columns are not read.
Scores must fit in a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 4096
GROUP_QUERIES = 256
SHORTLIST = 64
#: Shares of the lists after which bounds are compared.
DEPTHS = (0.3, 0.45, 0.6, 0.75, 0.9)

_LEAST = -(2 ** 63)


def fixed_point(vector: Column, scale: int = 256) -> Column:
    """Components as floor(scale * x), x as double; NULL for a vector that takes no part."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when((F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True)),
                  F.transform(doubles, lambda x: F.floor(scale * x)))


class Block:
    """The rows of a block with a sorted list for each component."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.lexsort([*rows.T[::-1], ids])  # of rows of one id the least comes first
        ids, rows = ids[order], rows[order]
        keep = np.concatenate([[True], ids[1:] != ids[:-1]]) if len(ids) else np.empty(0, bool)
        self.ids, self.rows = ids[keep], rows[keep]
        self.order = np.argsort(self.rows, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(self.rows, self.order.T, axis=0).T.astype(float)
        self.rank = np.empty(self.rows.shape, np.int32)
        np.put_along_axis(self.rank, self.order.T, np.arange(len(self.ids), dtype=np.int32)[:, None], axis=0)

    def shortlists(self, queries: np.ndarray, own: np.ndarray, floors: np.ndarray, k: int) -> list[np.ndarray]:
        """For each query (a row), places of the rows that may be among its best k."""
        n, out = len(self.ids), [None] * len(queries)
        reading = np.arange(len(queries))
        if n <= max(SHORTLIST, 4 * k):
            return [np.arange(n)] * len(queries)
        falling, rising = np.maximum(queries, 0.0).T, np.minimum(queries, 0.0).T  # components a list is read from
        others = self.ids[:, None] != own  # its top or its bottom for
        rows = self.rows.astype(float)
        for share in DEPTHS:
            read = int(n * share)
            top, bottom = self.rank >= n - read, self.rank < read
            up, down = falling[:, reading], rising[:, reading]
            known = np.where(top, rows, 0.0) @ up + np.where(bottom, rows, 0.0) @ down
            # What is unread is at most the entry the list has come to, at least the list's last.
            most = known + (~top).astype(float) @ (self.values[:, n - read, None] * up)
            most += (~bottom).astype(float) @ (self.values[:, read - 1, None] * down)
            least = known + (~top).astype(float) @ (self.values[:, 0, None] * up)
            least += (~bottom).astype(float) @ (self.values[:, -1, None] * down)
            least[~others[:, reading]] = -np.inf  # a query's own row bounds nothing
            bound = np.maximum(floors[reading], np.partition(least, n - k, axis=0)[n - k])
            may = most >= bound
            done = (may.sum(axis=0) <= SHORTLIST) | (share == DEPTHS[-1])
            for column in np.flatnonzero(done):
                out[reading[column]] = np.flatnonzero(may[:, column])
            reading = reading[~done]
            if not len(reading):
                break
        return out

    def best(self, queries: np.ndarray, own: np.ndarray, floors: np.ndarray,
             k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query, ids and scores of its best k rows but itself that reach its floor, in order."""
        for query, me, left in zip(queries, own, self.shortlists(queries, own, floors, k), strict=True):
            left = left[self.ids[left] != me]
            scores = self.rows[left] @ query
            top = np.lexsort((self.ids[left], -scores))[:k]
            yield self.ids[left][top], scores[top]


def _search(units: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score) of the best k of each unit; rows come sorted by unit, queries first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors: dict[int, list[int]] = {}  # the best scores each query of the group has so far
        group, held, held_key = None, [], None

        def finish() -> Iterator[tuple[int, int, int]]:
            nonlocal group
            if held_key is None:
                return
            if group != held_key[:2]:  # another group of queries: its scores start anew
                floors.clear()
                group = held_key[:2]
            queries = [h for h in held if h[0] == 0]
            rows = [h for h in held if h[0] == 1]
            if not queries or not rows:
                return
            block = Block(np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64))
            asked: dict[int, np.ndarray] = {}
            for _, own, vector in queries:
                if own not in asked or tuple(vector) < tuple(asked[own]):
                    asked[own] = vector
            own = np.array(list(asked), np.int64)
            best = [floors.setdefault(i, []) for i in asked]
            start = np.array([b[-1] if len(b) == k else -np.inf for b in best])
            found = block.best(np.array(list(asked.values()), np.int64), own, start, k)
            for i, (ids, scores) in zip(own.tolist(), found, strict=True):
                yield from zip([i] * len(ids), ids.tolist(), scores.tolist(), strict=True)
                floors[i] = sorted([*floors[i], *scores.tolist()], reverse=True)[:k]

        def batch_of(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                              names=["query_id", "vec_id", "score"])

        for batch in batches:
            out = []
            *keys, vectors = batch.columns
            offsets, values = vectors.offsets.to_numpy(), vectors.values.to_numpy()
            for i, (dim, asked, block, kind, own) in enumerate(zip(*[c.to_pylist() for c in keys], strict=True)):
                if (dim, asked, block) != held_key:
                    out += finish()
                    held, held_key = [], (dim, asked, block)
                held.append((kind, own, values[offsets[i]:offsets[i + 1]].copy()))
            yield batch_of(out)
        yield batch_of(list(finish()))

    return units.mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(queries: DataFrame, rows: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "v",
          block_rows: int = BLOCK_ROWS, group_queries: int = GROUP_QUERIES) -> DataFrame:
    """The k best rows for each query: query_id, rank (from 1), vec_id, score.

    Both tables have an id and an array of longs, such as ``fixed_point`` makes.
    """
    blocks = max(1, -(-rows.count() // block_rows))
    groups = max(1, -(-queries.count() // group_queries))

    def part(name: str, count: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(name), F.col(id_col)), F.lit(count)).cast("int")

    def valid(df: DataFrame) -> DataFrame:
        return df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).withColumn("dim", F.size(vec_col))

    asked = valid(queries).select("dim", part("group", groups).alias("asked"),
                                  F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                                  F.lit(0).alias("kind"), F.col(id_col).cast("long").alias("id"),
                                  F.col(vec_col).cast("array<long>").alias("v"))
    dealt = valid(rows).select("dim", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("asked"),
                               part("block", blocks).alias("block"), F.lit(1).alias("kind"),
                               F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<long>").alias("v"))
    units = (asked.union(dealt).repartition("dim", "asked", "block")
             .sortWithinPartitions("dim", "asked", "block", "kind"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (_search(units, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
