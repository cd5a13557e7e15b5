"""A representative subset of the registered queries against their DuckDB
SQL on sf0.001 (the full set runs with tools/oracle_check.py)."""

from __future__ import annotations

import os

import duckdb
import pytest

from commerce_lake.oracle import oracle_sql
from commerce_lake.queries import QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest

SUBSET = ["clean_orders", "quarantine_counts", "fact_order_line", "rfm", "product_rotation", "return_rate",
          "return_rate_incremental", "scd2_history", "expectation_results", "profile_anomalies"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows) > 0
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]
