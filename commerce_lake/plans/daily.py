"""One daily run, end to end: land the feeds of a run date, build and upsert
the curated zone, rebuild the marts, run the quality checks and record the
run's metrics row.  Replaying the same run date changes nothing: landing
overwrites its own partition, curated tables are keyed upserts (unchanged
rows are not appended), marts are replaced by one commit record each (the return
rate recomputes the months that the change logs touch), the metrics row is
upserted by run id.

This composes the library; it is not a scheduler (no retries, no
dependencies between processes) - the steps run in order in one session.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake.operators.asof import assert_no_overlap
from commerce_lake.operators.manifest import Manifest
from commerce_lake.operators.upsert import ChangeLog
from commerce_lake.plans import quality as Q
from commerce_lake.plans import runs as R
from commerce_lake.plans.pipeline import KEYS, PARTITIONS, ChangeLogStore, run_curated
from commerce_lake.schemas import FEEDS
from commerce_lake.sources import landing as L

MARTS = ["dim_customer", "dim_product", "dim_date", "dim_payment_method", "dim_delivery_status", "fact_order_line",
         "mart_customer_rfm", "mart_product_rotation", "mart_category_return_rate"]
STEPS = ["check_sources", *[f"ingest_{f}" for f in FEEDS], "curated", "marts", "quality"]


class QualityError(RuntimeError):
    """Expectations or relational tests failed and the run was asked to fail on them."""


@dataclass
class DailyResult:
    run_id: str
    steps: list = field(default_factory=list)  # (step, state, started_at, ended_at)
    landed: dict = field(default_factory=dict)
    failed_expectations: int = 0
    failed_tests: int = 0
    recomputed_months: list = field(default_factory=list)  # of the return rate; empty at its first build


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def daily_run(spark: SparkSession, source_dir: str, base: str, run_date: str, salt: str,
              as_of: str | None = None, run_ts: str | None = None, fail_on_error: bool = False) -> DailyResult:
    """Run every step for ``run_date``.  ``base`` holds raw/, curated/,
    marts/, quality/ and ops/.  ``run_ts`` is the snapshot time of the type-2
    dimensions (a parameter, so replays agree); it defaults to the run date.
    With ``fail_on_error`` a failed expectation or test fails the run, after
    its results are stored."""
    from commerce_lake.queries import Lake  # the warehouse view over a given curated zone

    base = base.rstrip("/")
    run_id = f"daily__{run_date}"
    res = DailyResult(run_id)
    run_ts = run_ts or f"{run_date} 00:00:00"
    as_of = as_of or run_date

    def step(name, fn):
        t0 = _now()
        try:
            out = fn()
            res.steps.append((name, "success", t0, _now()))
            return out
        except Exception:
            at = _now()
            res.steps.append((name, "failed", t0, at))
            res.steps += [(s, "upstream_failed", at, at) for s in STEPS[STEPS.index(name) + 1:]]
            _record(spark, base, run_id, run_date, res)
            raise

    step("check_sources", lambda: L.check_sources(spark, source_dir))
    for feed in FEEDS:
        r = step(f"ingest_{feed}", lambda f=feed: L.land(spark, source_dir, f"{base}/raw", f, run_date,
                                                          archive_root=f"{base}/raw/_archive"))
        res.landed[feed] = r.rows_out
    raw = {f: L.read_raw(spark, f"{base}/raw", f, run_date) for f in FEEDS}
    cur = step("curated", lambda: run_curated(raw, salt, run_date, ChangeLogStore(spark, f"{base}/curated")))

    lake = Lake(spark, base, as_of=as_of)
    lake.__dict__["cur"] = cur  # the warehouse reads the stored curated zone

    marts = mart_store(spark, base)

    def build_marts():
        from commerce_lake.plans import warehouse as W

        def stored(name, df, note=None):
            lake._stored[name] = marts.write(name, df, note)
            return lake._stored[name]

        # dimensions first: the fact reads the stored versions, checked for overlaps
        for name, key, df in (("dim_customer", "customer_id", _snapshot_dim(spark, base, cur, "customers", run_ts)),
                              ("dim_product", "product_id", _snapshot_dim(spark, base, cur, "products", run_ts))):
            dim = stored(name, df)
            if n := assert_no_overlap(dim, key):
                raise ValueError(f"{name}: {n} versions overlap the one before")
            lake.__dict__[name] = dim
        models = {"dim_date": W.dim_date(spark, orders=cur["orders"]), "dim_payment_method": W.dim_payment_method(cur),
                  "dim_delivery_status": W.dim_delivery_status(cur), "fact_order_line": lake.fact(),
                  "int_customer_order_stats": lake.customer_stats(), "mart_customer_rfm": lake.rfm(),
                  "mart_product_rotation": lake.rotation()}
        for name, df in models.items():
            stored(name, df)
        # the return rate is kept up by what changed in the curated logs since it was built
        logs = {t: ChangeLog(spark, f"{base}/curated/{t}", KEYS[t], PARTITIONS.get(t)) for t in W.RETURN_RATE_SOURCES}
        name, versions = "mart_category_return_rate", {t: log.latest_version() for t, log in logs.items()}
        if since := marts.note(name):
            res.recomputed_months = W.changed_months(logs, since)
            if res.recomputed_months:
                stored(name, W.mart_category_return_rate_from_changes(cur, marts.read(name), res.recomputed_months), versions)
            else:
                lake._stored[name] = marts.read(name)
        else:
            stored(name, lake.return_rate(), versions)

    step("marts", build_marts)

    def quality():
        from commerce_lake.plans import warehouse as W

        at = f"{base}/quality/{run_date}"
        exp = Q.expectation_results(cur)
        R.write_summary(exp, f"{at}/expectations")
        R.write_summary(Q.suite_summary(exp), f"{at}/expectation_summary")
        tests = Q.relational_tests(lake)
        R.write_summary(tests, f"{at}/relational_tests")
        R.write_summary(L.load_audit(spark, f"{base}/raw", [run_date]), f"{at}/load_audit")
        R.write_summary(R.volume_report({f: cur[f] for f in FEEDS}, W.stg_quarantine(cur)), f"{at}/volumes")
        res.failed_expectations = spark.read.json(f"{at}/expectations").where(~F.col("success")).count()
        res.failed_tests = spark.read.json(f"{at}/relational_tests").where(F.col("status") == "fail").count()
        if fail_on_error and (res.failed_expectations or res.failed_tests):
            raise QualityError(f"{res.failed_expectations} expectations and {res.failed_tests} tests failed")

    step("quality", quality)
    marts.purge()
    _record(spark, base, run_id, run_date, res)
    return res


def mart_store(spark: SparkSession, base: str) -> Manifest:
    """The marts of a lake: each is replaced by one commit record, never in place."""
    return Manifest(spark, f"{base.rstrip('/')}/marts")


def _snapshot_dim(spark: SparkSession, base: str, cur: dict[str, DataFrame], what: str, run_ts: str) -> DataFrame:
    """Customer or product dimension from a stored snapshot: each run applies
    itself to the versions stored so far, so earlier versions are kept."""
    from commerce_lake.plans import warehouse as W

    key = {"customers": "customer_id", "products": "product_id"}[what]
    snaps = ChangeLog(spark, f"{base}/snapshots/{what}", [key, "snapshot_valid_from"])
    previous = snaps.current() if snaps.latest_version() is not None else None
    snap = W.snap_customers(cur, run_ts, previous) if what == "customers" else W.snap_products(cur, previous)
    snaps.upsert(snap.drop("_ingested_at") if "_ingested_at" in snap.columns else snap, check_unique=False)
    return W.dim_customer(snaps.current()) if what == "customers" else W.dim_product(snaps.current())


def _record(spark: SparkSession, base: str, run_id: str, run_date: str, res: DailyResult) -> None:
    steps = spark.createDataFrame(
        [(run_id, "daily", run_date, s, st, a, b) for s, st, a, b in res.steps],
        "run_id string, dag_id string, logical_date string, step string, state string, started_at timestamp, "
        "ended_at timestamp")
    log = ChangeLog(spark, f"{base}/ops/pipeline_runs", ["run_id"])
    orders = quarantine = None
    for name in ("orders", "quarantine"):
        p = ChangeLog(spark, f"{base}/curated/{name}", KEYS[name], PARTITIONS.get(name))
        if p.latest_version() is not None:
            if name == "orders":
                orders = p.current()
            else:
                quarantine = p.current()
    row = R.with_volumes(R.run_state(steps), orders, quarantine)
    existing = log.current() if log.latest_version() is not None else None
    merged = R.record_runs(existing, row, _now().strftime("%Y-%m-%d %H:%M:%S"))
    log.upsert(merged.where(F.col("run_id") == run_id), check_unique=False)
