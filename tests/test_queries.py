"""Every registered query against its SQL twin, or for its shape where there is none."""

import glob
import os

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def as_text(rows):
    return sorted(tuple("\0" if v is None else str(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = df.select(*columns).collect()
    if name not in ORACLE:
        assert rows
        return
    twin = sql.sql(ORACLE[name])
    assert sorted(twin.columns) == columns
    names = ", ".join(f'"{c}"' for c in columns)
    assert as_text(rows) == as_text(sql.sql(f"SELECT {names} FROM ({ORACLE[name]})").fetchall())


def test_twins_belong_to_queries():
    assert set(ORACLE) <= set(QUERIES)
    assert len(ORACLE) > 60


def test_entry(spark):
    row = entry.entry(spark).first()
    assert (row.observation_count, row.price_index) == (27, 100.0)
