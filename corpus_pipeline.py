"""A corpus pipeline over ``documents``: language, lines, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and calls one operator of ``hackney.llm``; all but the last return the columns
of ``documents``. ``run`` writes each stage's result to the shared checkpoint
folder and reads it back for the next, so a lost executor never costs a stage
that is done.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.llm import langid, linededup, minhash, packing
from hackney.llm.common import materialise, read, ship_package

TOKENIZER = "word_bpe_49k.json"
#: A text is rejected if it has no letter or its best language's score is below this: texts of a
#: learned language score 0.4 and more, however noisy; a score of 0 shares no n-gram with any.
LEAST_SCORE = 0.25
BROADCAST_IDS = 1_000_000  # ids of 8 bytes

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that are in one of the languages the corpus teaches.

    NULL and letterless texts go; without any labelled text nothing can be
    learned and only those go.
    """
    ship_package(spark)
    profiles = langid.learn(docs)
    named = langid.identify(docs, profiles, keep=tuple(docs.columns))
    sure = (F.col("score") >= LEAST_SCORE) & (F.col("lang_pred") != langid.UNDETERMINED)
    if not profiles:
        sure = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return named.where(sure).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that occur earlier; documents of which nothing stays go."""
    cleaned = linededup.clean(docs, drop_emptied=True)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, 0.8) keeps the document of the least id.

    Rows that share an id are one document; the one of the least text stays.
    """
    ship_package(spark)
    judged = materialise(minhash.near_duplicates(docs), "judged")
    gone = judged.where(~F.col("kept")).select("doc_id").distinct()
    again = judged.groupBy("doc_id").agg(F.count("*").alias("n")).where((F.col("n") > 1) & F.col("doc_id").isNotNull())
    again = materialise(again.select("doc_id"), "repeated")
    stay = docs.join(_small(materialise(gone, "gone")), "doc_id", "left_anti")
    once = stay.join(_small(again), "doc_id", "left_anti")
    others = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    least = (stay.join(_small(again), "doc_id", "left_semi")
             .groupBy("doc_id").agg(F.min(F.struct("text", *others)).alias("row")).select("doc_id", "row.*"))
    return once.select(*docs.columns).union(least.select(*docs.columns))


def _small(ids: DataFrame) -> DataFrame:
    """Broadcast for a checked number of ids, by shuffle beyond; the result is the same."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every document's tokens in sequences of at most 2048."""
    ship_package(spark)
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language", identify_language),
    ("lines", dedup_lines),
    ("near_duplicates", dedup_near),
    ("packing", pack),
]

#: Language scores, edit distances and best-fit packing have no practical SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
