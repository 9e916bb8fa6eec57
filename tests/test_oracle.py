"""Every registered query against its DuckDB oracle on the smallest tables
(same comparison as the driver: column names, row count, order-free values)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as ENTRY
from tributary.plans.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
BATCH = [k for k in QUERIES if not k.startswith("t")]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events").split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = ENTRY.entry(spark)
    assert df.columns == ["key", "value"]
    assert df.count() > 0


@pytest.mark.parametrize("name", BATCH)
def test_query_matches_oracle(spark, con, name):
    df = ENTRY.queries()[name](spark, SF)
    got_rows, cols = df.collect(), df.columns
    cur = con.execute(ENTRY.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    want_rows = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    order = sorted(cols)
    a = sorted((tuple(_norm(r[c]) for c in order) for r in got_rows), key=repr)
    b = sorted((tuple(_norm(r[ocols.index(c)]) for c in order) for r in want_rows), key=repr)
    assert a == b
