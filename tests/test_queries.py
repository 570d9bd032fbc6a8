"""Every query that has SQL against DuckDB, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from textloom.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(map(tuple, frame[columns].astype(object).where(frame[columns].notna(), None).values.tolist()), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, name):
    assert rows(QUERIES[name](spark, DATA).toPandas()) == rows(con.sql(ORACLES[name]).df())
