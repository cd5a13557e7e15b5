"""Joins and windows with a third of the rows on one key, against plain forms; plans and task sizes."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from commerce_lake.operators.asof import asof_join, asof_ordered
from commerce_lake.operators.ranking import neighbours, row_number_within
from commerce_lake.operators.scd2 import history_from_changes
from commerce_lake.operators.skew import Sliced, attach, heavy_keys, key_hash


def skewed(spark, n=6000):
    """Key 7 and the null key have a third of the rows each."""
    return spark.range(n, numPartitions=4).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 2, F.col("id") % 400 + 100).cast("long").alias("k"))


@pytest.fixture()
def many_tasks(spark):
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold",
                                            "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    for c, v in before.items():
        spark.conf.set(c, v)


def largest_task(df):
    """Rows of the largest and of all tasks of the last stage."""
    # every column is read, so that no join is left out
    sizes = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max(F.hash("*"))).collect()]
    return max(sizes), sum(sizes)


def test_heavy_keys_are_found_and_light_ones_are_not(spark):
    df = skewed(spark)
    got = heavy_keys(df, ["k"], 0.1)
    want = {r["h"]: r["n"] for r in df.groupBy(key_hash(["k"]).alias("h")).agg(F.count("*").alias("n")).where("n > 600").collect()}
    assert got == want and len(got) == 2
    assert heavy_keys(df.limit(0), ["k"]) == {}
    assert heavy_keys(spark.range(1000).select(F.col("id").alias("k")), ["k"], 0.01) == {}


def test_attach_equals_the_plain_join_and_splits_the_hot_key(many_tasks):
    big = skewed(many_tasks)
    small = big.where("k is not null and k % 5 <> 1").groupBy("k").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    out = attach(big, small, ["k"], {"least": "least", "twice": F.col("n") * 2})
    plain = big.join(small, "k", "left").select("id", "k", "least", (F.col("n") * 2).alias("twice"))
    assert out.columns == plain.columns and out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan and "Union" not in plan
    most, total = largest_task(out)
    assert total == 6000 and most < 0.2 * total
    assert largest_task(plain)[0] > 0.3 * total  # what the plain form does


def test_attach_without_heavy_keys_and_with_empty_sides(spark):
    big = spark.createDataFrame([(1, 5), (2, None), (3, 6)], "id int, k long")
    small = spark.createDataFrame([(5, "x")], "k long, v string")
    rows = lambda df: sorted((tuple(r) for r in df.collect()))
    for heavy in ({}, None):
        assert rows(attach(big, small, ["k"], {"v": "v"}, heavy)) == [(1, 5, "x"), (2, None, None), (3, 6, None)]
    assert rows(attach(big, small.limit(0), ["k"], {"v": "v"}))[0] == (1, 5, None)
    assert rows(attach(big.limit(0), small, ["k"], {"v": "v"})) == []


def events(spark, n=3000, seed=3):
    rnd = random.Random(seed)
    t0 = dt.datetime(2026, 1, 1)
    rows = [(i, 7 if i % 3 == 0 else None if i % 17 == 0 else rnd.randrange(60), t0 + dt.timedelta(minutes=rnd.randrange(900)), rnd.choice("aab") if i % 29 else None)
            for i in range(n)]
    return spark.createDataFrame(rows, "id long, k long, t timestamp, v string")


@pytest.mark.parametrize("share", [None, 0.9])  # with and without slices
def test_sliced_windows_equal_plain_windows(many_tasks, share):
    df = events(many_tasks)
    w = Window.partitionBy("k").orderBy("t", "id")
    want = df.select("*", F.lag("v").over(w).alias("b"), F.lead("id").over(w).alias("a"), F.row_number().over(w).cast("long").alias("n"),
                     F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("l"))
    heavy = heavy_keys(df, ["k"], share)
    assert bool(heavy) == (share is None)
    s = Sliced.of(df, ["k"], ["t", "id"], heavy).before(F.col("v"), "b").after(F.col("id"), "a").number("n").last_known(F.col("v"), "l")
    got = s.select("id", "k", "t", "v", "b.v", "a.v", "n", "l").toDF(*want.columns)
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()
    if heavy:
        most, total = largest_task(s.df)
        assert most < 0.25 * total


def test_sliced_windows_share_one_exchange_of_the_rows(many_tasks):
    df = events(many_tasks)
    h = history_from_changes(df, "k", ["t", "id"], ["v"], heavy={})
    plan = h._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "rangepartitioning" not in plan and plan.count("Sort [") == 1


def test_history_numbers_and_neighbours_with_a_hot_key(many_tasks):
    df = events(many_tasks)
    w = Window.partitionBy("k").orderBy("t", "id")
    kept = df.withColumn("p", F.lag("v").over(w)).withColumn("r", F.row_number().over(w)).where("r = 1 or not p <=> v")
    want = kept.select("id", "k", "t", "v", F.col("t").alias("valid_from"), F.lead("t").over(w).alias("valid_to"),
                       F.row_number().over(w).cast("long").alias("version_no"), F.lead("t").over(w).isNull().alias("is_current"))
    got = history_from_changes(df, "k", ["t", "id"], ["v"])
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()
    numbered = row_number_within(df, ["k"], ["id"], "n").select("id", "n")
    assert numbered.exceptAll(df.select("id", F.row_number().over(Window.partitionBy("k").orderBy("id")).cast("long"))).isEmpty()
    near = neighbours(df, ["k"], ["t", "id"], ["id"]).select("id", "prev_id", "next_id", "is_first")
    assert near.exceptAll(df.select("id", F.lag("id").over(w), F.lead("id").over(w), F.row_number().over(w) == 1)).isEmpty()


def versions(spark, keys):
    """Versions of 100 minutes, with a gap before the last; key 7 has three hundred short ones."""
    t0 = dt.datetime(2026, 1, 1)
    rows = [(k, f"{k}-{j}", t0 + dt.timedelta(minutes=100 * j), t0 + dt.timedelta(minutes=100 * (j + 1) - (30 if j == 4 else 0)))
            for k in keys if k != 7 for j in range(6)]
    rows += [(7, f"7-{j}", t0 + dt.timedelta(minutes=3 * j), t0 + dt.timedelta(minutes=3 * j + 3)) for j in range(300)]
    return spark.createDataFrame(rows, "k long, name string, valid_from timestamp, valid_to timestamp")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_ordered_asof_join_equals_the_interval_join(many_tasks, how):
    fact, dim = events(many_tasks), versions(many_tasks, range(50))
    got, want = asof_ordered(fact, dim, "k", "k", "t", how), asof_join(fact, dim, "k", "k", "t", how)
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and got.count() == want.count()
    edge = fact.where("k = 7").join(dim.select("valid_from").distinct(), F.col("t") == F.col("valid_from"))
    assert edge.count() > 100  # many facts lie exactly on a border
    most, total = largest_task(got)
    assert most < 0.3 * total


def test_ordered_asof_join_defined_cases(spark):
    t = dt.datetime(2026, 1, 5)
    fact = spark.createDataFrame([(1, "a", t), (2, None, t), (3, "a", None), (4, "zz", t), (5, "b", t)], "id int, k string, t timestamp")
    dim = spark.createDataFrame([("a", 1, t, None), ("b", 2, dt.datetime(2026, 1, 1), t), (None, 3, t, None), ("zz", 4, None, None)],
                                "k string, n int, valid_from timestamp, valid_to timestamp")
    got = {r["id"]: r["d_n"] for r in asof_ordered(fact, dim, "k", "k", "t").collect()}
    assert got == {1: 1, 2: None, 3: None, 4: None, 5: None}
    assert asof_ordered(fact, dim.limit(0), "k", "k", "t").count() == 5
    assert asof_ordered(fact.limit(0), dim, "k", "k", "t").count() == 0
