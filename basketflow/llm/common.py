"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path

# Functions travel to the workers by value: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__.rpartition(".")[0]])

_WORD = re.compile(r"\w+")
# Entries that a worker's memo may hold before it starts anew.
MEMO_ENTRIES = 250_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame, *more) -> DataFrame:
    """doc_id as long and text with null as empty; every other column of the input is left behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, with underscores behind those that a column of df has already (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def one_of_each(docs: DataFrame, key: Column, kept: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id and text key are among the kept (doc_id, key), one row of each; which of several is not stated.

    Repeated rows meet within a task before they move. Null doc_ids are equal to each other. Columns of docs may have any names.
    """
    names = free_names(docs, "no_id", "id", "key")

    def keyed(doc_id: Column, text_key: Column) -> list[Column]:
        return [c.alias(n) for c, n in zip((doc_id.isNull(), F.coalesce(doc_id, F.lit(0)), text_key), names)]

    one = docs.select("*", *keyed(F.col("doc_id").cast("long"), key)).dropDuplicates(names)
    held = kept.select(*keyed(F.col("doc_id"), F.col("key"))).distinct()
    return one.join(held.hint("merge"), names, "left_semi").drop(*names)


def words(text: str) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    return _WORD.findall(text.lower())


class Memo(dict):
    """A dict that fills itself by a function and starts anew when it is full."""

    def __init__(self, make, entries: int = MEMO_ENTRIES):
        self.make, self.entries = make, entries

    def __missing__(self, key):
        if len(self) >= self.entries:
            self.clear()
        value = self[key] = self.make(key)
        return value


def worker_state(operator: str, name: str, make: Callable):
    """An object that lives in the Python worker, which Spark reuses for later tasks, until another operator asks for one of its own."""
    held = sys.__dict__.setdefault("_basketflow_llm", {})
    if held.get("operator") != operator:
        held.clear()
        held["operator"] = operator
    if name not in held:
        held[name] = make()
    return held[name]


def hash64(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words, in order."""
    found = words(text)
    memo = worker_state("words", "hashes", lambda: Memo(hash64))
    return np.fromiter(map(memo.__getitem__, found), np.uint64, len(found))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of every run of n words."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - n + 1 + i]
    out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


def rows_of(batches: Iterator, *columns: str) -> Iterator[tuple]:
    """Rows of Arrow batches as Python tuples, one batch in memory at a time."""
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))
