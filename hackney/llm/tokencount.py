"""Token counts: a two-tier lookup on the map side, without a shuffle.

Tier one is a broadcast hash table with the lengths (in ids) of frequent
pre-tokens, bounded by the tokenizer's vocabulary. Tier two is each Python
worker's bounded cache, filled by encoding the pre-tokens that missed. No
pre-token is ever shuffled; the plan is one scan and one map.

Defined cases: NULL text counts as empty (0 bytes, 0 tokens); empty and
blank texts have 0 tokens; repeated rows and NULL ids give a row each; an
empty table gives none; columns other than the id and the text are not
read, so their names cannot clash. Long texts are never truncated.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.llm import wordtok

MAX_TOKENS = 2048


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = MAX_TOKENS) -> DataFrame:
    """One row per document: ``id_col``, n_bytes, n_tokens, over_limit.

    ``tokenizer_path`` is read on the driver and its content broadcast, so
    executors need no copy: a tokenizers ``.json`` or a sentencepiece
    ``.model``. Counts are without added special tokens, truncation, padding.
    """
    context = docs.sparkSession.sparkContext
    with open(tokenizer_path, "rb") as file:
        content = file.read()
    is_model = tokenizer_path.endswith(".model")
    spec = context.broadcast(content)
    table = context.broadcast({} if is_model else wordtok.frequent_lengths(content.decode()))

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if is_model:
            import sentencepiece
            processor = sentencepiece.SentencePieceProcessor(model_proto=spec.value)
            length = lambda text: len(processor.encode(text))
        else:
            length = wordtok.of_worker(spec.value.decode(), table.value).length
        for batch in batches:
            ids, n_bytes, texts = batch.columns
            counts = [length(text.as_py()) for text in texts]
            yield pa.RecordBatch.from_arrays([ids, n_bytes, pa.array(counts, pa.int64())],
                                             names=["id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"),
                       F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    counted = rows.mapInArrow(lengths, f"id {id_type}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))
