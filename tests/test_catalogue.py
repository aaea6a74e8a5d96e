"""Every catalogue query that SQL can express, against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from docloom.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{SF}/{name}'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(repr([None if v is None or v != v else round(v, 6) if isinstance(v, float) else v for v in r]) for r in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query(spark, duck, name):
    assert rows(catalogue.QUERIES[name](spark, SF).toPandas()) == rows(duck.sql(catalogue.ORACLES[name]).df())
