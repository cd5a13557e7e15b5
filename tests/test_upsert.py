"""Keyed upsert, change log, time travel, diff, restore, late corrections."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from commerce_lake.operators.upsert import ChangeLog, DuplicateKeyError, upsert_frames
from tests.conftest import rows


def kv(spark, data):
    return spark.createDataFrame(data, "k string, v string")


def test_upsert_frames_replay_and_update(spark):
    t = kv(spark, [("1", "a"), ("2", "b")])
    again = upsert_frames(t, kv(spark, [("1", "a"), ("2", "b")]), ["k"])
    assert sorted(map(tuple, again.collect())) == [("1", "a"), ("2", "b")]
    out = upsert_frames(again, kv(spark, [("2", "B"), ("3", "c")]), ["k"])
    assert sorted(map(tuple, out.collect())) == [("1", "a"), ("2", "B"), ("3", "c")]


def test_upsert_null_safe_keys(spark):
    t = kv(spark, [(None, "a"), ("2", "b")])
    out = upsert_frames(t, kv(spark, [(None, "A")]), ["k"])
    assert sorted(map(lambda r: (r[0] or "", r[1]), out.collect())) == [("", "A"), ("2", "b")]


def test_upsert_update_columns_only(spark):
    t = spark.createDataFrame([("1", "x", "old")], "k string, keep string, v string")
    s = spark.createDataFrame([("1", "y", "new"), ("2", "z", "ins")], "k string, keep string, v string")
    out = {r["k"]: r for r in upsert_frames(t, s, ["k"], update_cols=["v"]).collect()}
    assert out["1"]["keep"] == "x" and out["1"]["v"] == "new" and out["2"]["v"] == "ins"
    only = upsert_frames(t, s, ["k"], update_cols=["v"], insert=False)
    assert only.count() == 1


def test_duplicate_source_keys_fail(spark):
    with pytest.raises(DuplicateKeyError):
        upsert_frames(kv(spark, [("1", "a")]), kv(spark, [("2", "b"), ("2", "c")]), ["k"])


def test_change_log_versions_time_travel_diff_restore(spark, scratch):
    log = ChangeLog(spark, f"{scratch}/t", ["k"])
    v0 = log.upsert(kv(spark, [("1", "a"), ("2", "b")]))
    v1 = log.upsert(kv(spark, [("1", "a"), ("2", "b")]))  # replay: nothing new
    v2 = log.upsert(kv(spark, [("2", "B"), ("3", "c")]))
    assert (v0, v1, v2) == (0, 1, 2)
    assert sorted(map(tuple, log.current().collect())) == [("1", "a"), ("2", "B"), ("3", "c")]
    assert sorted(map(tuple, log.current(as_of_version=1).collect())) == [("1", "a"), ("2", "b")]
    hist = {r["version"]: r["rows_written"] for r in log.history().collect()}
    assert [r["version"] for r in log.recent_versions(2).collect()] == [2, 1]
    assert hist == {0: 2, 1: 0, 2: 2}
    assert sorted(map(tuple, log.diff(2, 1).collect())) == [("2", "B"), ("3", "c")]
    log.restore_rows(kv(spark, [("2", None)]), to_version=1)
    assert sorted(map(tuple, log.current().collect())) == [("1", "a"), ("2", "b"), ("3", "c")]


def test_late_correction_applied_twice_is_idempotent(spark, scratch):
    log = ChangeLog(spark, f"{scratch}/deliveries", ["delivery_id"])
    base = spark.createDataFrame([("D1", "IN_TRANSIT", None), ("D2", "DELIVERED", 2)],
                                 "delivery_id string, delivery_status string, delay int")
    log.upsert(base)
    late = spark.createDataFrame([("D1", "DELIVERED", 9)], "delivery_id string, delivery_status string, delay int")
    log.upsert(late)
    n_after_first = log.current().count()
    log.upsert(late)
    assert log.current().count() == n_after_first == 2
    assert {r["version"]: r["rows_written"] for r in log.history().collect()}[2] == 0
    before = log.current(as_of_version=0).where(F.col("delivery_id") == "D1").first()
    assert before["delivery_status"] == "IN_TRANSIT"


def test_uncommitted_version_is_invisible(spark, scratch):
    log = ChangeLog(spark, f"{scratch}/t", ["k"])
    log.upsert(kv(spark, [("1", "a")]))
    # a half-done append: data written, commit never recorded
    kv(spark, [("1", "zzz")]).withColumn("_version", F.lit(5).cast("long")).withColumn("_attempt", F.lit("alost")).write.mode(
        "append").partitionBy("_version", "_attempt").parquet(log.data_path)
    assert rows(log.current()) == [{"k": "1", "v": "a"}]


def test_compact_keeps_current_state(spark, scratch):
    log = ChangeLog(spark, f"{scratch}/t", ["k"])
    log.upsert(kv(spark, [("1", "a"), ("2", "b")]))
    log.upsert(kv(spark, [("2", "B")]))
    new = log.compact(f"{scratch}/t2")
    assert sorted(map(tuple, new.current().collect())) == [("1", "a"), ("2", "B")]
    assert [(r["version"], r["operation"]) for r in new.history().collect()] == [(0, "COMPACT")]


@pytest.mark.parametrize("retry", [[("c", "2026-03")], []])
def test_rows_of_a_failed_append_stay_invisible(spark, scratch, monkeypatch, retry):
    schema = "k string, m string"
    log = ChangeLog(spark, f"{scratch}/t", ["k"], ["m"])
    log.upsert(spark.createDataFrame([("a", "2026-01")], schema))
    commit = ChangeLog._commit
    monkeypatch.setattr(ChangeLog, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        log.upsert(spark.createDataFrame([("b", "2026-02")], schema))
    monkeypatch.setattr(ChangeLog, "_commit", commit)
    log.upsert(spark.createDataFrame(retry, schema))
    assert sorted(r["k"] for r in log.current().collect()) == sorted(["a", *[k for k, _ in retry]])


def test_changes_both_ways_and_restore_finds_the_version(spark, scratch):
    log = ChangeLog(spark, f"{scratch}/t", ["k"])
    log.upsert(kv(spark, [("1", "a"), ("2", "b")]))
    log.upsert(kv(spark, [("2", "B"), ("3", "c")]))
    got = sorted((r["k"], r["v"], r["_change"]) for r in log.changes(0, 1).collect())
    assert got == [("2", "B", "added"), ("2", "b", "removed"), ("3", "c", "added")]
    log.upsert(kv(spark, [("1", "A")]))
    log.restore_rows(kv(spark, [("2", None)]))
    assert sorted(tuple(r) for r in log.current().select("k", "v").collect()) == [("1", "A"), ("2", "b"), ("3", "c")]
    with pytest.raises(ValueError):
        log.restore_rows(kv(spark, [("9", None)]))


@pytest.mark.parametrize("partition_by", [None, ["m"]])
def test_an_upsert_of_few_keys_opens_the_files_it_touches(spark, scratch, partition_by):
    log = ChangeLog(spark, f"{scratch}/a b", ["k"], partition_by)
    months = F.concat(F.lit("2026-0"), (F.col("id") / 1000).cast("int") + 1)
    every = spark.range(4000, numPartitions=8).select(F.col("id").alias("k"), months.alias("m"), F.lit("old").alias("v"))
    conf = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {c: spark.conf.get(c) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        log.upsert(every)
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    few = spark.createDataFrame([(17, "2026-01", "new"), (20, "2026-01", "new"), (None, "2026-09", "no key")], "k long, m string, v string")
    whole, some = ([f for f in df.inputFiles() if "/data/" in f] for df in (log.current(), log.current(keys_of=few)))
    assert len(whole) >= 4 and len(some) == 1
    log.upsert(few)
    assert {(r["k"], r["v"]) for r in log.current(keys_of=few).collect()} == {(17, "new"), (20, "new"), (None, "no key")}
    assert log.current().count() == 4001
    log.upsert(spark.createDataFrame([(None, "2026-09", "again"), (3999, "2026-04", "new")], "k long, m string, v string"))
    assert log.current().where("k is null").first()["v"] == "again" and log.current().count() == 4001
    assert log.current(keys_of=few.where("k > 10000")).count() == 0
    assert log.history().where("version = 2").first()["rows_written"] == 2


def test_compaction_in_place_is_one_commit_and_vacuum_removes_the_rest(spark, scratch, monkeypatch):
    log = ChangeLog(spark, f"{scratch}/t", ["k"])
    log.upsert(kv(spark, [("1", "a"), ("2", "b")]))
    log.upsert(kv(spark, [("2", "B")]))
    commit = ChangeLog._commit
    monkeypatch.setattr(ChangeLog, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        log.compact_in_place()
    monkeypatch.setattr(ChangeLog, "_commit", commit)
    state = [("1", "a"), ("2", "B")]
    assert sorted(map(tuple, log.current().collect())) == state
    assert log.compact_in_place() == 2
    assert sorted(map(tuple, log.current().collect())) == state and sorted(map(tuple, log.current(0).collect())) == [("1", "a"), ("2", "b")]
    assert log.diff(2, 1).isEmpty()
    assert log.vacuum() == 3  # two versions and the lost attempt
    assert sorted(map(tuple, log.current().collect())) == state
    log.upsert(kv(spark, [("3", "c")]))
    assert sorted(map(tuple, log.current().collect())) == [*state, ("3", "c")] and log.vacuum() == 0
