"""Language identification by rank-order profiles of character n-grams.

A profile is the ``size`` most frequent n-grams (one to three letters, words
padded by a blank) in rank order. A text's own profile is compared with each
language's: an n-gram's out-of-place distance is the difference of its two
ranks, or ``size`` if the language's profile lacks it; the language with the
least sum is predicted, ties to the language first in order.

Profiles are learned from a bounded sample of labelled documents: each
language gives at most ``per_language`` distinct pairs of id and text (those of
the least hashes, each taken whole; a language with fewer gives all). What reaches the
driver is ``size`` n-grams a language. Predictions use whole texts.

Defined cases: NULL texts and texts without a letter are ``und`` with score
0; NULL ids, repeated rows and very short texts are rows like others; an
empty table gives no rows; without any labelled document all are ``und``;
columns other than id, text and language are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hackney.llm.common import bounded_sample, ship_package

PROFILE_SIZE = 400
DOCS_PER_LANGUAGE = 2000
UNDETERMINED = "und"

_BITS = 21  # a code point; three fit in a long
_BLANK = 32

Profiles = dict[str, tuple[np.ndarray, np.ndarray]]  # language -> codes in order, the rank of each


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngrams(text: str) -> np.ndarray:
    """Codes of all n-grams of one to three characters, of which one at least is a letter."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # of each run without letters, the first stands as a blank
    keep[0] = True
    points = np.where(letter, points, _BLANK)[keep].astype(np.int64)
    letter = letter[keep]
    if not letter.any():
        return np.empty(0, np.int64)
    if not letter[0] and len(letter) > 1 and not letter[1]:
        points, letter = points[1:], letter[1:]
    one = points[letter]
    two = (points[:-1] << _BITS) | points[1:]
    three = (points[:-2] << 2 * _BITS) | (points[1:-1] << _BITS) | points[2:]
    return np.concatenate([one, two, three[letter[1:-1]]])


def ranked(codes: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent codes, by falling count, ties to the smaller code."""
    distinct, counts = np.unique(codes, return_counts=True)
    return distinct[np.argsort(-counts, kind="stable")[:size]]


def held_out(id_col: str) -> Column:
    """Whether a document is kept from learning: CRC-32 of its id as text is 2 modulo 4."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          size: int = PROFILE_SIZE, per_language: int = DOCS_PER_LANGUAGE) -> Profiles:
    """The profile of every language that occurs in ``docs`` (labelled rows only are used)."""
    ship_package(docs.sparkSession)
    sample = (bounded_sample(docs, [id_col, text_col], text_col, per_language, lang_col)
              .select(F.col("group").alias("lang"), F.col("value").alias("text")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                texts.setdefault(lang, []).append(ngrams(text.as_py()))
            for lang, parts in texts.items():
                codes, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()),
                                                  pa.array(codes), pa.array(n)], names=["lang", "code", "n"])

    totals = (sample.select("lang", "text").mapInArrow(count, "lang string, code long, n long")
              .groupBy("lang", "code").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    rows = (totals.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
            .select("lang", "code", "rank").collect())
    profiles: Profiles = {}
    for lang in sorted({r["lang"] for r in rows}):
        codes, ranks = np.array([(r["code"], r["rank"] - 1) for r in rows if r["lang"] == lang]).T
        order_ = np.argsort(codes)
        profiles[lang] = codes[order_], ranks[order_]
    return profiles


def distances(text: str, profiles: Profiles, size: int) -> np.ndarray | None:
    """Out-of-place distance to each profile as a share of the largest possible; None without letters."""
    own = ranked(ngrams(text), size)
    if not len(own):
        return None
    rank = np.arange(len(own))
    out = np.empty(len(profiles))
    for k, (codes, ranks) in enumerate(profiles.values()):
        at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
        out[k] = np.where(codes[at] == own, np.abs(ranks[at] - rank), size).sum()
    return out / (size * len(own))


def identify(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text",
             size: int = PROFILE_SIZE, keep: tuple[str, ...] = ()) -> DataFrame:
    """The id (and the columns of ``keep``) of every document with lang_pred and score."""
    ship_package(docs.sparkSession)
    names = list(profiles)
    model = docs.sparkSession.sparkContext.broadcast(profiles)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(0):
                text = text.as_py()
                far = distances(text, model.value, size) if text and names else None
                best = None if far is None else int(np.argmin(far))
                langs.append(UNDETERMINED if far is None else names[best])
                scores.append(0.0 if far is None else min(1.0, max(0.0, 1.0 - float(far[best]))))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names[1:], "__lang", "__score"])

    columns = list(dict.fromkeys((id_col, *keep)))
    rows = docs.select(F.col(text_col).alias("__text"), *columns)
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return (rows.mapInArrow(predict, f"{fields}, __lang string, __score double")
            .withColumnsRenamed({"__lang": "lang_pred", "__score": "score"}))
