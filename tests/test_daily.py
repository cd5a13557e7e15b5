"""Daily run end to end from CSV feeds; the same run date twice leaves every
table unchanged."""

from __future__ import annotations

from pyspark.sql import functions as F

from commerce_lake.operators.upsert import ChangeLog
import pytest

from commerce_lake.plans.daily import MARTS, STEPS, _snapshot_dim, daily_run, mart_store
from commerce_lake.plans.pipeline import KEYS, PARTITIONS
from commerce_lake.schemas import FEED_COLUMNS
from commerce_lake.sources import fixtures as fx
from tests.conftest import SF_SMALL


def _write_csv_feeds(spark, folder):
    for feed, df in fx.raw_feeds(spark, SF_SMALL).items():
        cols = FEED_COLUMNS[feed] + (["first_name", "last_name"] if feed == "customers" else [])
        df.select(*[F.col(c).cast("string").alias(c) for c in cols]).coalesce(1).write.option(
            "header", True).csv(f"{folder}/{feed}.csv")


def _snapshot(spark, base):
    marts = {m: mart_store(spark, base).read(m) for m in MARTS}
    return {m: sorted(map(tuple, df.collect()), key=str) for m, df in marts.items()}


def test_daily_run_twice_gives_identical_tables(spark, scratch):
    src, base = f"{scratch}/source", f"{scratch}/lake"
    _write_csv_feeds(spark, src)
    r1 = daily_run(spark, src, base, "2001-08-02", "salt")
    assert r1.landed["order_lines"] == 6000 and all(s[1] == "success" for s in r1.steps)
    first = _snapshot(spark, base)
    assert len(first["fact_order_line"]) > 0 and len(first["mart_customer_rfm"]) > 0
    r2 = daily_run(spark, src, base, "2001-08-02", "salt")
    assert _snapshot(spark, base) == first
    for t in ("orders", "order_lines", "customers", "quarantine"):
        hist = sorted(ChangeLog(spark, f"{base}/curated/{t}", KEYS[t], PARTITIONS.get(t)).history().collect())
        assert hist[-1]["rows_written"] == 0  # the replay appended nothing
    runs = ChangeLog(spark, f"{base}/ops/pipeline_runs", ["run_id"]).current().collect()
    assert len(runs) == 1 and runs[0]["state"] == "success" and runs[0]["orders_count"] > 0
    assert r2.failed_tests == r1.failed_tests and r2.recomputed_months == []
    audit = spark.read.json(f"{base}/quality/2001-08-02/load_audit")
    assert audit.where("landed").count() == 6 and spark.read.json(f"{base}/quality/2001-08-02/volumes").count() > 6


def test_return_rate_from_changes_equals_a_full_build(spark, scratch):
    """Corrections in old months, a changed category, lines that come and a group that goes."""
    from commerce_lake.plans import warehouse as W
    from commerce_lake.plans.pipeline import ChangeLogStore, run_curated

    raw = fx.raw_feeds(spark, SF_SMALL)
    some = raw["orders"].where("order_id % 4 = 0")
    store = ChangeLogStore(spark, f"{scratch}/curated")
    first = {**raw, "orders": some, "order_lines": raw["order_lines"].where("order_id % 4 = 0 and order_id % 40 <> 0")}
    cur = run_curated(first, "s", "2001-08-01", store)
    logs = {t: ChangeLog(spark, f"{scratch}/curated/{t}", KEYS[t], PARTITIONS.get(t)) for t in W.RETURN_RATE_SOURCES}
    since = {t: log.latest_version() for t, log in logs.items()}
    marts = mart_store(spark, scratch)
    built = marts.write("m", W.mart_category_return_rate(cur), since)
    assert W.changed_months(logs, marts.note("m")) == []
    late = F.col("order_date") < F.lit("1996-01-01").cast("timestamp")
    second = {**first, "orders": some.withColumn("order_status", F.when(late & (F.col("order_id") % 12 == 0), "RETURNED").otherwise(F.col("order_status")))
              .withColumn("updated_at", F.when(late & (F.col("order_id") % 12 == 0), F.expr("updated_at + INTERVAL 9 DAYS")).otherwise(F.col("updated_at"))),
              "order_lines": first["order_lines"].unionByName(raw["order_lines"].where("order_id = 40")),
              "products": raw["products"].withColumn("category_name", F.when(F.col("product_id") == 7, "MOVED").otherwise(F.col("category_name")))}
    cur = run_curated(second, "s", "2001-08-02", store)
    months = W.changed_months(logs, marts.note("m"))
    assert 0 < len(months) < built.select("order_year_month").distinct().count()
    got = W.mart_category_return_rate_from_changes(cur, marts.read("m"), months)
    want = W.mart_category_return_rate(cur)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert not want.exceptAll(built).isEmpty()
    marts.write("m", got, {t: log.latest_version() for t, log in logs.items()})
    assert marts.purge() == 1 and marts.read("m").count() == want.count()


def test_product_versions_are_kept_from_day_to_day(spark, scratch):
    def products(price, day):
        return {"products": spark.createDataFrame(
            [("p1", price, f"{day} 08:00:00")], "product_id string, unit_price double, updated_at string").withColumn(
            "updated_at", F.col("updated_at").cast("timestamp"))}

    from commerce_lake.plans import warehouse as W

    stg, dim = W.stg_products, W.dim_product
    try:
        W.stg_products = lambda cur: cur["products"]
        W.dim_product = lambda snap: snap
        _snapshot_dim(spark, scratch, products(1.0, "2001-01-01"), "products", "2001-01-02 00:00:00").count()
        two = _snapshot_dim(spark, scratch, products(2.0, "2001-02-01"), "products", "2001-02-02 00:00:00")
        rows = sorted((r["unit_price"], r["snapshot_valid_to"] is None) for r in two.collect())
        assert rows == [(1.0, False), (2.0, True)]
    finally:
        W.stg_products, W.dim_product = stg, dim


def test_a_missing_source_leaves_a_failed_run(spark, scratch):
    with pytest.raises(Exception):
        daily_run(spark, f"{scratch}/nothing", f"{scratch}/lake", "2001-08-02", "salt")
    run = ChangeLog(spark, f"{scratch}/lake/ops/pipeline_runs", ["run_id"]).current().first()
    assert run["state"] == "failed" and set(run["failed_tasks"]) == set(STEPS)
