"""Token counts with the whole-token shortcut."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, id_text
from .word_bpe import blocks, word_bpe

LIMIT = 2048


def token_counts(docs: DataFrame, limit: int = LIMIT, tokenizer: str | None = None) -> DataFrame:
    """Every row of docs: doc_id, n_bytes, n_tokens, over_limit.

    Counts are those of the library without added special tokens. Pre-tokens that are proven to be one token count one; only others
    are merged. Null texts are empty: no bytes, no tokens. Texts of any length count whole. Repeated rows and null doc_ids
    count like others. No rows give no rows. Other columns are ignored.
    """

    def count(batches):
        bpe = word_bpe(tokenizer)
        for batch in blocks(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(bpe.counts(batch.column("text")))], names=["doc_id", "n_bytes", "n_tokens"])

    rows = id_text(docs, F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long").alias("n_bytes"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))
