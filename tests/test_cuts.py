"""Exact cuts against the plain ntile window: ties, nulls, hot values, few
rows, samples far too small, and a plan without exchange or sort."""

from __future__ import annotations

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from commerce_lake.operators import cuts
from commerce_lake.operators.ranking import naive_ntile

SCORES = {"a": ["v", "id"], "b": ["c", "amt", "id"], "d": ["day", "id"], "t": ["name", "id"]}


def data(spark, n):
    rnd = random.Random(n)
    rows = []
    for i in range(n):
        v = 7 if i % 3 == 0 else rnd.randint(0, 50)
        amt = None if i % 11 == 0 else Decimal(rnd.randint(0, 100000)) / 100
        day = None if i % 7 == 0 else datetime.date(1995, 1, 1) + datetime.timedelta(days=rnd.randint(0, 900))
        rows.append((f"k{i}", None if i % 13 == 0 else v, rnd.randint(0, 2), amt, day, rnd.choice(["é", "z", "Z", "", "ab", "😀", "￮"])))
    return spark.createDataFrame(rows, "id string, v int, c smallint, amt decimal(12,2), day date, name string")


@pytest.mark.parametrize("n", [0, 1, 3, 5, 13, 400, 3001])
@pytest.mark.parametrize("sample", [8, 64, 100_000])
def test_equals_the_window(spark, n, sample):
    df = data(spark, n)
    got = {r["id"]: [r[s] for s in SCORES] for r in cuts.cut_ntiles(df, 5, SCORES, sample).collect()}
    want = df
    for s, cols in SCORES.items():
        want = naive_ntile(want, 5, [F.col(c).asc_nulls_last() for c in cols], s)
    assert got == {r["id"]: [r[s] for s in SCORES] for r in want.collect()}
    assert len(got) == n


def test_no_shuffle_and_no_sort(spark):
    plan = cuts.cut_ntiles(data(spark, 500), 5, SCORES, 64)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan


def test_reads_stay_small(spark, monkeypatch):
    """A cut's sample and its last read are near the bound, whatever the rows."""
    seen, read = [], cuts._read

    def counting(*args):
        out = read(*args)
        seen.extend(len(x) for x in out)
        return out

    monkeypatch.setattr(cuts, "_read", counting)
    df = spark.range(200_000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 977).alias("v"))
    got = cuts.cut_keys(df, 4, {"s": ["v", "id"]}, 256)
    want = df.orderBy("v", "id").select("v", "id").collect()
    assert [(k[1], k[3]) for k in got["s"]] == [tuple(want[50_000 * j - 1]) for j in (1, 2, 3)]
    assert max(seen) <= 2 * 256


def test_refuses_an_order_that_is_not_total_and_floats(spark, monkeypatch):
    monkeypatch.setattr(cuts, "PASSES", 5)
    same = spark.range(100).select(F.lit(1).alias("v"))
    with pytest.raises(ValueError, match="not total"):
        cuts.cut_keys(same, 5, {"s": ["v"]}, 8)
    with pytest.raises(TypeError):
        cuts.cut_keys(spark.range(3).select(F.col("id").cast("double").alias("v")), 5, {"s": ["v"]})
