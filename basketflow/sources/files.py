"""Small marker files beside the data, on whatever file system a path names. Spark does not read names that begin with an underscore."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in a folder, in order, without drafts; none if it isn't there."""
    at, fs = _path(spark, folder)
    found = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(name for name in found if not name.startswith("."))


def size(spark: SparkSession, folder: str) -> int:
    """Bytes of a folder with all in it, from its listing; 0 if it isn't there."""
    at, fs = _path(spark, folder)
    return fs.getContentSummary(at).getLength() if fs.exists(at) else 0


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    folder, _, name = path.rpartition("/")
    draft, fs = _path(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(text.encode())
    out.close()
    final, _ = _path(spark, path)
    fs.delete(final, False)
    if not fs.rename(draft, final):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    at, fs = _path(spark, path)
    stream = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file, or a folder with all in it; nothing happens if it isn't there."""
    at, fs = _path(spark, path)
    fs.delete(at, True)
