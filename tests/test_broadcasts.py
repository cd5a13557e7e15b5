"""Joins are broadcast for rows that were counted, never for the size of compressed files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from commerce_lake.plans import curated as C
from commerce_lake.plans import quality as Q
from commerce_lake.plans import warehouse as W
from commerce_lake.plans.pipeline import ParquetStore
from commerce_lake.schemas import FEED_COLUMNS
from commerce_lake.session import fits_broadcast
from tests.test_curated import DEFAULTS, SALT

N = 4000


def many(spark, name, n, **columns):
    """``n`` text rows of a feed: its defaults but for the given expressions of ``id``."""
    rows = spark.range(n).select(
        *[F.expr(columns[c]).cast("string").alias(c) if c in columns else F.lit(DEFAULTS[name].get(c)).alias(c)
          for c in FEED_COLUMNS[name] + (["first_name", "last_name"] if name == "customers" else [])])
    return rows.withColumn("_ingested_at", F.lit("2025-04-10 00:00:00").cast("timestamp")).withColumn("_run_date", F.lit("2025-04-10"))


def market(spark):
    return C.CuratedZone({
        "products": many(spark, "products", 20, product_id="id"), "customers": many(spark, "customers", 5, customer_id="id", email_hash="id"),
        "payments": many(spark, "payments", N, payment_id="id", order_id="id"),
        "orders": many(spark, "orders", N, order_id="id", customer_id="id % 5"),
        "order_lines": many(spark, "order_lines", N, order_line_id="id", order_id="id", product_id="id % 20"),
        "deliveries": many(spark, "deliveries", N, delivery_id="id", order_id="id"),
    }, SALT, "2025-04-10", ParquetStore.scratch(spark, "test"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_orders_that_fit_as_files_only_are_not_broadcast(spark):
    # 4,000 rows are some 256 kB in memory, their order ids some 10 kB of the stored files
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200k")
    try:
        z = market(spark)
        lines = W.return_rate_lines(z)
        assert plan(lines).count("BroadcastHashJoin") == 1  # the products
        assert plan(lines).count("SortMergeJoin") == 4
        assert "BroadcastHashJoin" not in plan(W.orders_enriched(z)) + plan(W.stg_payments(z))
        assert plan(W.return_rate_lines(z, months=["2025-04"])).count("BroadcastHashJoin") == 1
        test = next(t for t in Q.GENERIC_TESTS if t.test_id == "relationships_stg_payments_order_id__stg_orders_order_id")
        assert "BroadcastHashJoin" not in plan(Q._generic(test, {"stg_payments": W.stg_payments(z), "stg_orders": W.stg_orders(z)}, z))
        assert lines.count() == N and W.orders_enriched(z).count() == N
        rate = sorted(map(tuple, W.mart_category_return_rate(z).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rate == sorted(map(tuple, W.mart_category_return_rate(market(spark)).collect()))


def test_small_sides_are_broadcast(spark):
    z = market(spark)
    assert "SortMergeJoin" not in plan(W.orders_enriched(z))
    # rows that nobody counted are not
    assert "BroadcastHashJoin" not in plan(W.orders_enriched({n: z[n] for n in ("orders", "payments", "deliveries")}))


@pytest.mark.parametrize("threshold,rows,fits", [("10485760b", 163_840, True), ("10485760b", 163_841, False), ("256k", 4096, True),
                                                 ("10MB", 163_841, False), ("-1", 0, False), ("6400", 100, True)])
def test_rows_are_compared_in_memory(spark, threshold, rows, fits):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        assert fits_broadcast(spark, rows) is fits
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
