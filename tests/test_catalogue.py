"""Every registered query of the engine against its SQL in DuckDB."""

import glob
import os

import duckdb
import pytest

from tidemark.plans.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    want = duck.execute(f"SELECT {', '.join(f'\"{c}\"' for c in columns)} FROM ({SQL[name]})").fetchall()
    key = lambda r: [(v is None, str(v)) for v in r]
    assert sorted(map(tuple, got.select(*columns).collect()), key=key) == sorted(want, key=key)
