"""Every query with SQL gives what DuckDB gives on the same tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple("nan" if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in rows]
    return sorted(columns), sorted(plain, key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    found = canonical(df.columns, df.collect())
    answer = duck.execute(ORACLES[name])
    expected = canonical([d[0] for d in answer.description], answer.fetchall())
    assert found == expected


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert {r["split"] for r in rows} == {"train", "eval", "test"}
