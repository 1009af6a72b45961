"""The corpus pipeline: quality, exact copies, near copies, packing. Each stage is written and reread as the next one's docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketflow.llm.common import documents, stash
from basketflow.llm.exact_dedup import keep_first
from basketflow.llm.ngram_join import keep_one
from basketflow.llm.packing import packed
from basketflow.llm.resample import keep_sampled

STAGES = [
    ("quality", keep_sampled),
    ("exact_dedup", keep_first),
    ("near_dedup", keep_one),
    ("packing", packed),
]

# Hashed models, MinHash links and tokens can't be written in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that every stage kept, with their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null texts are empty, null doc_ids are an id like others; of rows equal in id and text one stays. No documents give no rows. Columns
    of documents may have any names.
    """
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
