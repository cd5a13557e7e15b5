"""Stored frames leave no shuffle files behind; a fact stored in slices is the whole fact."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from commerce_lake import queries
from commerce_lake.operators.ranking import global_row_number
from commerce_lake.plans import quality as Q
from commerce_lake.plans.pipeline import ParquetStore
from tests.test_broadcasts import N, market


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").split("\n") if "/shuffle_" in f}


def left_by(spark, run):
    """Shuffle files that ``run`` made and that are still there."""
    before = shuffle_files(spark)
    run()
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def test_a_write_takes_its_shuffle_files_along(spark):
    store = ParquetStore.scratch(spark, "test")
    sums = lambda n: spark.range(n).groupBy((F.col("id") % 100).alias("k")).agg(F.sum("id").alias("s"))
    keep = []
    assert not left_by(spark, lambda: keep.append(store("t", sums(5000))))
    assert not left_by(spark, lambda: keep.append(global_row_number(sums(5000), [F.col("k").asc()])))
    assert keep[0].count() == 100 and keep[1].agg(F.max("row_number")).first()[0] == 100


def test_slices_are_one_table(spark):
    store = ParquetStore.scratch(spark, "test")
    back = store.slices("t", (spark.range(i * 10, i * 10 + 10) for i in range(3)))
    assert sorted(r[0] for r in back.collect()) == list(range(30))
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        store("t", spark.range(1))
    assert back.count() == 30


def lake_of(spark, zone):
    lake = queries.Lake(spark, "unused")
    lake.__dict__["cur"] = zone
    return lake


def test_a_fact_in_slices_is_the_whole_fact(spark, monkeypatch):
    zone = market(spark)
    whole, sliced = lake_of(spark, zone), lake_of(spark, zone)
    expected = sorted(map(str, whole.fact().collect()))
    monkeypatch.setattr(queries, "FACT_LINES", N // 3)
    parts = []
    monkeypatch.setattr(zone, "store", ParquetStore.scratch(spark, "test"))
    made = queries.Lake.fact
    monkeypatch.setattr(queries.Lake, "fact", lambda self, n=1, i=0: parts.append((n, i)) or made(self, n, i))
    stored = sliced.stored_fact()
    assert parts == [(4, 0), (4, 1), (4, 2), (4, 3)] and len(expected) == N
    assert sorted(map(str, stored.select(*whole.fact().columns).collect())) == expected
    assert sliced.stored_fact() is stored


def test_the_tests_of_a_model_leave_no_shuffle_files(spark, monkeypatch):
    monkeypatch.setattr(queries, "FACT_LINES", N // 2)
    lake, made = lake_of(spark, market(spark)), []
    left = left_by(spark, lambda: made.append(Q.relational_tests(lake)))
    rows = {r["test_id"]: r["failures"] for r in made[0].collect()}
    assert len(rows) == 65
    assert rows["assert_fact_row_count_matches_staging"] == rows["assert_fact_total_matches_staging"] == 0
    # only small aggregates that the driver reads (heavy keys, counts, cuts) leave theirs to its garbage collector
    data = [f for f in left if f.endswith(".data")]
    assert sum(os.path.getsize(f) for f in data if os.path.exists(f)) < 100_000
