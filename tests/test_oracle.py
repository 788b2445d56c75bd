"""Every query with an SQL equivalent gives the same rows as that SQL in another engine."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from tests.conftest import SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
ORACLE = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


def cells(frame: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if pd.isna(v):
            return (1, "")
        if isinstance(v, (bool,)) or str(v) in ("True", "False"):
            return (0, str(bool(v)))
        if hasattr(v, "year"):
            return (0, str(v)[:10])
        if isinstance(v, str):
            return (0, v)
        return (0, f"{float(v):.6f}")

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(cell(v) for v in row) for row in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(name, spark, duck):
    ours = QUERIES[name](spark, SMALL).toPandas()
    theirs = duck.execute(ORACLE[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) == len(theirs)
    assert cells(ours) == cells(theirs)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
