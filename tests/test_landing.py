"""Landing zone: text scan, lineage, replay-safe partition, archive, audit."""

from __future__ import annotations

import os

import pytest

from commerce_lake.schemas import FEED_COLUMNS
from commerce_lake.sources import landing as L


def write_orders_csv(folder, n=3, extra_rows=0):
    os.makedirs(folder, exist_ok=True)
    cols = FEED_COLUMNS["orders"]
    with open(f"{folder}/orders.csv", "w", encoding="utf-8") as f:
        f.write(",".join(cols) + "\n")
        for i in range(n + extra_rows):
            vals = [f"O{i}" if c == "order_id" else ("12,5" if c == "promo_code" else "x") for c in cols]
            vals = [f'"{v}"' if "," in v else v for v in vals]
            f.write(",".join(vals) + "\n")


def test_land_counts_lineage_archive(spark, scratch):
    src, raw, arc = f"{scratch}/source", f"{scratch}/raw", f"{scratch}/archive"
    write_orders_csv(src)
    res = L.land(spark, src, raw, "orders", "2026-09-30", archive_root=arc)
    assert (res.rows_in, res.rows_out, res.status) == (3, 3, "success")
    df = L.read_raw(spark, raw, "orders", "2026-09-30")
    assert {"_source_file", "_ingested_at", "_run_date"} <= set(df.columns)
    assert all(t == "string" for c, t in df.dtypes if not c.startswith("_") or c in ("_source_file", "_run_date"))
    assert df.first()["_source_file"] == "orders.csv"
    assert spark.read.text(f"{arc}/orders/2026-09-30").count() == 4  # header + 3 lines


def test_replay_replaces_only_its_partition(spark, scratch):
    src, raw = f"{scratch}/source", f"{scratch}/raw"
    write_orders_csv(src)
    L.land(spark, src, raw, "orders", "2026-09-29")
    L.land(spark, src, raw, "orders", "2026-09-30")
    L.land(spark, src, raw, "orders", "2026-09-30")
    assert L.read_raw(spark, raw, "orders", "2026-09-30").count() == 3
    assert L.read_raw(spark, raw, "orders", "2026-09-29").count() == 3


def test_missing_file_and_columns(spark, scratch):
    with pytest.raises(L.MissingFeedError):
        L.land(spark, f"{scratch}/nothing", f"{scratch}/raw", "orders", "2026-09-30")
    with pytest.raises(L.MissingFeedError) as e:
        L.check_sources(spark, f"{scratch}/nothing")
    assert "payments" in str(e.value) and "orders" in str(e.value)
    os.makedirs(f"{scratch}/bad")
    with open(f"{scratch}/bad/orders.csv", "w") as f:
        f.write("order_id\nO1\n")
    with pytest.raises(ValueError):
        L.read_feed(spark, f"{scratch}/bad/orders.csv", "orders")


def test_load_audit_shows_missing_feeds(spark, scratch):
    src, raw = f"{scratch}/source", f"{scratch}/raw"
    write_orders_csv(src)
    L.land(spark, src, raw, "orders", "2026-09-30")
    audit = {(r["feed"], r["run_date"]): r["rows"] for r in
             L.load_audit(spark, raw, ["2026-09-30"], ["orders", "payments"]).collect()}
    assert audit == {("orders", "2026-09-30"): 3, ("payments", "2026-09-30"): 0}


def test_an_empty_redelivery_is_a_valid_copy(spark, scratch):
    src, raw = f"{scratch}/source", f"{scratch}/raw"
    write_orders_csv(src)
    L.land(spark, src, raw, "orders", "2026-09-30")
    write_orders_csv(src, n=0)
    res = L.land(spark, src, raw, "orders", "2026-09-30")
    assert (res.rows_in, res.rows_out, res.status) == (0, 0, "success")
    df = L.read_raw(spark, raw, "orders", "2026-09-30")
    assert df.count() == 0 and "_ingested_at" in df.columns and "order_id" in df.columns
    rows = L.load_audit(spark, raw, ["2026-09-30", "2026-10-01"], ["orders"]).collect()
    assert sorted((r["run_date"], r["rows"], r["landed"]) for r in rows) == [("2026-09-30", 0, True), ("2026-10-01", 0, False)]
    assert L.manifest(spark, raw, "orders").purge() == 1  # the first delivery


def test_a_delivery_that_does_not_reconcile_changes_nothing(spark, scratch, monkeypatch):
    src, raw = f"{scratch}/source", f"{scratch}/raw"
    write_orders_csv(src)
    L.land(spark, src, raw, "orders", "2026-09-30")
    write_orders_csv(src, n=5)
    m = L.Manifest.write
    monkeypatch.setattr(L.Manifest, "write", lambda self, key, df, note=None, check=None: m(self, key, df, note, lambda n, f: check(n + 1, f)))
    with pytest.raises(L.ReconciliationError):
        L.land(spark, src, raw, "orders", "2026-09-30")
    assert L.read_raw(spark, raw, "orders", "2026-09-30").count() == 3
    with pytest.raises(FileNotFoundError):
        L.read_raw(spark, raw, "orders", "2026-10-09")
