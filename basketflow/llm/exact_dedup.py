"""Exact duplicates by skew-safe combining, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, id_text, one_of_each, stash

SALTS = 64


def normalised(text: Column) -> Column:
    """Every run of space, tab, newline, vertical tab, form feed and return as one space."""
    # Single spaces, which stand between most words, need no replacing and so don't match.
    return F.regexp_replace(text, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def classes(docs: DataFrame, digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """One row per distinct normalised text: digest, body, keep_id, group_size.

    Three stages, each grouping on the full content beside the digest: rows of a task (the partial aggregation
    before the shuffle), rows of a digest and salt, winners of the salts. A group of any size
    reaches the last stage as at most one row per salt.
    """
    body = id_text(docs).select("doc_id", normalised(F.col("text")).alias("body"))
    rows = body.select("doc_id", digest(F.col("body")).alias("digest"), "body", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"))
    salted = rows.groupBy("digest", "salt", "body").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return salted.repartition("digest").groupBy("digest", "body").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """Every row of docs with the class of its text: doc_id, keep_id, group_size, kept, digest.

    Of equal normalised texts the smallest doc_id stays. Null texts count as empty, so they equal empty ones.
    Null doc_ids never win against others; where a class has only such, keep_id is null and its rows stay. Repeated
    rows of one doc_id count each, and stay or go together. No rows give no rows. Other columns are ignored.

    Digests are shared by different texts only if they collide. Such digests (none for SHA-256 in practice) are looked
    for, and their rows matched by content.
    """
    found = classes(docs, digest, salts)
    # Still dealt by digest: no further shuffle, and the contents stay behind.
    by_digest = stash(
        found.groupBy("digest").agg(F.count(F.lit(1)).alias("variants"), F.min("keep_id").alias("keep_id"), F.min("group_size").alias("group_size")),
        "exact-classes",
    )
    rows = id_text(docs).select("doc_id", normalised(F.col("text")).alias("body")).select("doc_id", digest(F.col("body")).alias("digest"), "body")
    single = by_digest.filter("variants = 1").drop("variants")
    out = rows.drop("body").join(single.hint("merge"), "digest")  # a digest with many rows: adaptive execution splits it
    shared = by_digest.filter("variants > 1").select("digest")
    if not shared.isEmpty():
        contents = found.join(shared, "digest", "left_semi")
        out = out.unionByName(rows.join(contents, ["digest", "body"]).drop("body"))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).withColumnRenamed("digest", "text_sha256")


OP4_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
       sha256(body) AS text_sha256
FROM n WINDOW w AS (PARTITION BY body)
"""


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: exactly one row of each group of equal texts, all columns of docs. Decided by doc_id and text digest, not by doc_id alone."""
    kept = exact_dedup(docs).filter("kept").select("doc_id", F.col("digest").alias("key"))
    return one_of_each(docs, sha256(normalised(F.coalesce(F.col("text").cast("string"), F.lit("")))), kept)
