"""Small inputs that the tests of all operators share."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Columns that operators use inside come along as input columns, to clash with theirs.
ODD = "doc_id long, text string, lang string, source string, n_chars long, node string, digest string, salt int, length long, _bucket int, root string, kept boolean, shard int"
TEXTS = [
    (1, "One two three four five six seven eight nine ten"),
    (2, "one two three four five  six seven eight nine ten"),
    (3, ""),
    (4, None),
    (5, " \t\n "),
    (6, "One two three four five six seven eight nine ten"),
    (7, "é ß 日本語 ́ İ ǅ \x1c 　 <|endoftext|> it's 12 0x1F"),
    (8, "word " * 9000),
    (8, "word " * 9000),
    (None, "a text without an id"),
    (None, None),
    (9, "x"),
]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame([(i, t, None, "s", None, "n", "d", 1, 7, 0, "r", True, 3) for i, t in TEXTS], ODD)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], ODD)
