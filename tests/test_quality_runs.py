"""Expectation suites, relational test list, run state and metrics rows."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from commerce_lake.plans import quality as Q
from commerce_lake.plans import runs as R


def test_suites_hold_the_25_rules():
    assert {t: len(r) for t, r in Q.SUITES.items()} == {"orders": 9, "customers": 6, "products": 5, "payments": 5}


def test_relational_tests_are_65():
    kinds = Counter(t.kind for t in Q.GENERIC_TESTS)
    assert kinds == {"unique": 15, "not_null": 21, "relationships": 10, "accepted_values": 14}
    assert len(Q.GENERIC_TESTS) + len(Q.SINGULAR_TESTS) == 65


def test_mostly_and_unique_semantics(spark):
    df = spark.createDataFrame([(1, 5), (1, -1), (2, 10), (3, None)] + [(4 + i, 1) for i in range(998)],
                               "id int, amount int")
    rules = [Q.Expect("unique", "id"), Q.Expect("between", "amount", min_value=0, mostly=0.999),
             Q.Expect("between", "amount", min_value=0), Q.Expect("not_null", "amount", mostly=0.95)]
    got = list(Q.run_suite("t", df, rules).orderBy("expectation").collect())
    uniq = [r for r in got if r["expectation"].endswith("unique")][0]
    assert uniq["unexpected_count"] == 2 and not uniq["success"]  # both members of the repeated value
    betweens = sorted([r for r in got if r["expectation"].endswith("between")], key=lambda r: r["success"])
    assert [b["success"] for b in betweens] == [False, True]  # 1 of 1001 non-null fails: passes only with mostly
    nn = [r for r in got if r["expectation"].endswith("null")][0]
    assert nn["unexpected_count"] == 1 and nn["success"]


def test_run_state_and_metrics_upsert(spark):
    steps = spark.createDataFrame([
        ("r1", "dag", "2026-01-01", "ingest", "success", "2026-01-01 01:00:00", "2026-01-01 01:10:00"),
        ("r1", "dag", "2026-01-01", "curated", "failed", "2026-01-01 01:10:00", "2026-01-01 01:20:00"),
        ("r1", "dag", "2026-01-01", "marts", "upstream_failed", "2026-01-01 01:20:00", "2026-01-01 01:21:00"),
        ("r2", "dag", "2026-01-02", "ingest", "success", "2026-01-02 01:00:00", "2026-01-02 01:05:00")],
        "run_id string, dag_id string, logical_date string, step string, state string, started_at string, "
        "ended_at string").withColumns({"started_at": F.col("started_at").cast("timestamp"),
                                        "ended_at": F.col("ended_at").cast("timestamp")})
    st = {r["run_id"]: r for r in R.run_state(steps).collect()}
    assert st["r1"]["state"] == "failed" and st["r1"]["failed_tasks"] == ["curated", "marts"]
    assert st["r2"]["state"] == "success" and st["r2"]["duration_s"] == 300.0
    orders = spark.range(7)
    first = R.record_runs(None, R.with_volumes(R.run_state(steps), orders, None), "2026-01-02 02:00:00")
    assert first.where("run_id = 'r1'").first()["orders_count"] == 7
    # run r2 recorded again later with a new start time: start keeps its first value
    again = R.with_volumes(R.run_state(steps.where("run_id = 'r2'").withColumn(
        "started_at", F.col("started_at") + F.expr("INTERVAL 1 HOUR"))), orders, None)
    merged = {r["run_id"]: r for r in R.record_runs(first, again, "2026-01-02 03:00:00").collect()}
    assert str(merged["r2"]["started_at"]).startswith("2026-01-02 01:00")
    assert str(merged["r2"]["recorded_at"]).startswith("2026-01-02 03:00")
    assert str(merged["r1"]["recorded_at"]).startswith("2026-01-02 02:00")


def test_volume_report_summary_and_json(spark, scratch):
    q = spark.createDataFrame([("orders", "NO_LINES"), ("orders", "NO_LINES"), ("orders", "BAD_TOTAL")],
                              "source string, reason string")
    rep = R.volume_report({"orders": spark.range(5), "payments": spark.range(2)}, q)
    got = [(r["section"], r["name"], r["reason"], r["row_count"]) for r in rep.collect()]
    assert got == [("quarantine", "orders", "BAD_TOTAL", 1), ("quarantine", "orders", "NO_LINES", 2),
                   ("table", "orders", None, 5), ("table", "payments", None, 2)]
    R.write_summary(rep, f"{scratch}/summary")
    assert spark.read.json(f"{scratch}/summary").count() == 4
    res = Q.run_suite("t", spark.createDataFrame([(1,), (None,)], "x int"), [Q.Expect("not_null", "x")])
    summ = Q.suite_summary(res).first()
    assert (summ["expectations"], summ["failed"], summ["success"]) == (1, 1, False)


def test_relationships_count_rows_but_move_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (3,), (3,), (3,), (None,)], "k int")
    m = {"child": child, "parent": spark.createDataFrame([(1,), (None,), (1,)], "p int")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = Q._generic(Q.Test("relationships", "child", "k", to="parent", field="p"), m)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate(keys=[k#" in plan.split("LeftAnti")[1] and out.first()["failures"] == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    m["child"] = child.where("k = 1")
    assert Q._generic(Q.Test("relationships", "child", "k", to="parent", field="p"), m).first()["failures"] == 0
