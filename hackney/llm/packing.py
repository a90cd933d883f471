"""Best-fit packing of tokenised documents into fixed-size training sequences.

Documents become pieces of at most ``tokens`` ids; pieces are dealt by a hash
of the row's number, stored when it is cut, over shards of a few thousand pieces
(a count of shards in proportion to the data, so no task grows with it; rows
never share a number, whatever their ids, so no key can be hot) and each shard is packed by vector best-fit in order of decreasing length. A bin
has three residual capacities: tokens, documents and attention cost (the sum
of squared lengths). Of the bins in which a piece fits under all three, the
one is taken that minimises the weighted norm of what would remain
(``rule="norm"``) or maximises the weighted dot product of the piece's and
the bin's residual vectors (``rule="dot"``). A shard leaves at most about one
sequence open, which at the default size is below 0.05 % of its sequences.

Defined cases: NULL or empty text is a document of just the closing id;
repeated rows are packed each; NULL ids are packed like others; an empty
table gives no rows; other columns are not read. A piece that exceeds a
capacity by itself (more than ``documents`` < 1, or its squared length above
``attention``) gets a sequence of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.llm import wordtok
from hackney.llm.common import materialise

END_ID = 0
SHARD_PIECES = 8192


@dataclass(frozen=True)
class Capacity:
    """What one sequence holds, and how much each residual weighs in the choice of a bin."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 1e-6, 1e-6)
    rule: str = "norm"


def pieces(docs: DataFrame, tokenizer_path: str, capacity: Capacity = Capacity(),
           id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of every document: id, piece, start, length, ids_crc32 (and ids as binary), __row (its own number)."""
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    width = 4 * capacity.tokens
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = wordtok.of_worker(spec.value).ids
        following = TaskContext.get().partitionId() << 40
        for batch in batches:
            owner, number, starts, lengths, crcs, raw = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = ids_of(text.as_py()) + end
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at:at + width]
                    owner.append(row)
                    number.append(k)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    crcs.append(zlib.crc32(part))
                    if with_ids:
                        raw.append(part)
            columns = [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(number, pa.int32()),
                       pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(raw, pa.binary()))
                names.append("ids")
            columns.append(pa.array(range(following, following + len(owner)), pa.int64()))
            names.append("__row")
            following += len(owner)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids + ", __row long"
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(cut, schema).withColumnRenamed("id", id_col)


def best_fit(lengths: np.ndarray, capacity: Capacity) -> np.ndarray:
    """Bin number of each piece, the pieces being in order of decreasing length."""
    n = len(lengths)
    full = np.array([capacity.tokens, capacity.documents, capacity.attention], float)
    weights = np.array(capacity.weights) / full ** 2
    left = np.empty((n, 3))  # residual capacities of open bins
    number = np.empty(n, np.int64)
    out = np.empty(n, np.int64)
    opened, used = 0, 0
    least = float(lengths[-1]) if n else 0.0
    for i, length in enumerate(lengths.tolist()):
        need = np.array([length, 1.0, float(length) * length])
        room = left[:opened] - need
        fits = (room >= 0).all(axis=1).nonzero()[0]
        if len(fits):
            if capacity.rule == "dot":
                chosen = fits[np.argmax(left[fits] @ (need * weights))]
            else:
                chosen = fits[np.argmin((room[fits] ** 2) @ weights)]
            out[i] = number[chosen]
            left[chosen] = room[chosen]
            if left[chosen, 0] < least or left[chosen, 1] < 1 or left[chosen, 2] < least * least:
                opened -= 1  # nothing that is still to come fits: close the bin
                left[chosen], number[chosen] = left[opened], number[opened]
            continue
        out[i] = used
        rest = full - need
        if rest[0] >= least and rest[1] >= 1 and rest[2] >= least * least:
            left[opened], number[opened] = rest, used
            opened += 1
        used += 1
    return out


def pack(parts: DataFrame, capacity: Capacity = Capacity(), id_col: str = "doc_id",
         shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``parts`` (stored rows of ``pieces``) with sequence_id and offset, without __row.

    ``parts`` is read twice (a count and the packing): pass a written table,
    so that a row's number is the same each time.
    """
    count = parts.count()
    shards = max(1, -(-count // shard_pieces))
    shard = F.pmod(F.xxhash64("__row", F.lit("shard")), F.lit(shards)).cast("int")

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", id_col, "piece", "__row"], ascending=[False, True, True, True], kind="stable")
        bins = best_fit(frame["length"].to_numpy(), capacity)
        base = np.int64(frame["__shard"].iat[0]) << 32
        frame["sequence_id"] = base + bins
        order = frame.groupby("sequence_id", sort=False)["length"]
        frame["offset"] = (order.cumsum() - frame["length"]).astype("int64")
        return frame.drop(columns=["__shard", "__row"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields if f.name != "__row")
    return (parts.withColumn("__shard", shard).groupBy("__shard")
            .applyInPandas(fill, f"{fields}, sequence_id long, offset long"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: Capacity = Capacity(),
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, cut and pack: a row per piece with its place in a sequence."""
    parts = materialise(pieces(docs, tokenizer_path, capacity, id_col, text_col), "pieces")
    return pack(parts, capacity, id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, length, ids (binary, in order of offset).

    Needs ``packed`` from pieces made ``with_ids``; a group holds at most one
    sequence, so its size is bounded by the capacity.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.concat_ws("", F.transform(ordered, lambda part: F.hex(part["ids"])))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.unhex(joined).alias("ids"))
