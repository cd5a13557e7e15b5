"""Registered queries: one per operator / model of the blueprint.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole test tables.  Output columns are aliased to the names the SQL oracle
uses; ``comparable`` turns exact decimals into doubles and small integers
into bigint, after all arithmetic is done.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_lake.operators import ranking
from commerce_lake.operators.asof import asof_ordered
from commerce_lake.operators.latest import top1_by
from commerce_lake.operators.scd2 import VALID_FROM, VALID_TO, history_from_changes, snapshot_check, snapshot_timestamp
from commerce_lake.operators.skew import heavy_keys
from commerce_lake.operators.upsert import ChangeLog, upsert_frames
from commerce_lake.plans import curated as C
from commerce_lake.plans import profile as PR
from commerce_lake.plans import quality as Q
from commerce_lake.plans import runs as R
from commerce_lake.plans import warehouse as W
from commerce_lake.plans.pipeline import ParquetStore
from commerce_lake.sources import fixtures as fx

RUN_TS = fx.INGESTED_AT  # snapshot time of the fixture run
#: Order lines of which a stored fact is built at a time.
FACT_LINES = 50_000_000
INCREMENTAL_CUTOFF = "2001-01-01"


def comparable(df: DataFrame) -> DataFrame:
    """Decimals -> double, int/short/byte -> bigint, lineage columns dropped."""
    cols = []
    for f in df.schema.fields:
        if f.name.startswith("_"):
            continue
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


class Lake:
    """Lazily composed pipeline over one fixture directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, orders_filter=None, as_of: str = fx.AS_OF_DATE, whole: "Lake | None" = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.orders_filter = orders_filter
        self.as_of = as_of
        self.whole = whole  # the lake of all orders, whose tables that no order decides this one shares
        self._stored: dict[str, DataFrame] = {}

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        feeds = fx.cached_raw_feeds(self.spark, self.sf_dir)
        if self.orders_filter is not None:
            feeds["orders"] = feeds["orders"].where(self.orders_filter)
        return feeds

    @cached_property
    def cur(self) -> dict[str, DataFrame]:
        """The curated zone: each table is built when a query first asks for
        it and stored as Parquet under spark.checkpoint.dir, as the curated zone
        is a stored layer that the marts read."""
        return C.CuratedZone(self.raw, fx.HASH_SALT, fx.RUN_DATE, ParquetStore.scratch(self.spark),
                             shared=self.whole.cur if self.whole is not None else None)

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """What ``build`` gives, written once per lake beside its curated zone."""
        if name not in self._stored:
            self._stored[name] = self.cur.store(f"models/{name}", build())
        return self._stored[name]

    def stored_fact(self) -> DataFrame:
        """The fact, written once: slices of the orders with all that belongs to them, whose wide rows are on disk
        for one slice at a time."""
        name = "fact_order_line"
        if name not in self._stored:
            n = max(1, -(-self.cur.rows("order_lines") // FACT_LINES))
            self._stored[name] = self.cur.store.slices(f"models/{name}", (self.fact(n, i) for i in range(n)))
        return self._stored[name]

    def _model(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stored model if there is one, else its plan."""
        return self._stored[name] if name in self._stored else build()

    @cached_property
    def dim_customer(self) -> DataFrame:
        return W.dim_customer(W.snap_customers(self.cur, RUN_TS))

    @cached_property
    def dim_product(self) -> DataFrame:
        return W.dim_product(W.snap_products(self.cur))

    def customer_stats(self) -> DataFrame:
        return W.customer_order_stats(self.spark, self.cur)

    def product_stats(self) -> DataFrame:
        return W.product_sales_stats(self.cur, self.as_of)

    def rfm(self) -> DataFrame:
        return W.mart_customer_rfm(self._model("int_customer_order_stats", self.customer_stats), self.as_of)

    def rotation(self) -> DataFrame:
        return W.mart_product_rotation(self._model("dim_product", lambda: self.dim_product), self.product_stats(), self.as_of)

    def return_rate(self) -> DataFrame:
        return W.mart_category_return_rate(self.cur)

    def fact(self, slices: int = 1, number: int = 0) -> DataFrame:
        """The fact, or what one of so many slices of the orders gives."""
        cur = self.cur
        if slices > 1:
            mine = F.pmod(F.xxhash64(F.col("order_id").cast("string")), F.lit(slices)) == number
            cut = {t: cur[t].where(mine) for t in ("orders", "order_lines", "payments", "deliveries")}
            cur = C.Part(cur, cut, W.RETURN_RATE_SOURCES)
        return W.fact_order_line(cur, self._model("dim_customer", lambda: self.dim_customer),
                                 self._model("dim_product", lambda: self.dim_product))


def _lake(spark: SparkSession, sf_dir: str, variant: str = "full") -> Lake:
    """One Lake per session, directory and variant, so that the queries of a
    session share their (lazy) plans instead of rebuilding them."""
    cache = spark.__dict__.setdefault("_cl_lakes", {})
    key = (sf_dir, variant)
    if key not in cache:
        cache[key] = (Lake(spark, sf_dir, orders_filter=first_run_filter(), whole=_lake(spark, sf_dir))
                      if variant == "first_run" else Lake(spark, sf_dir))
    return cache[key]


def _quarantine_view(lake: Lake, source: str) -> DataFrame:
    """Rejected rows of one feed with their payload, from its stored classified rows."""
    return lake.cur.rejects(source)


# ----------------------------------------------------------------------------- curated
def q_latest_orders(spark, sf):
    cur = _lake(spark, sf).cur
    return comparable(C.newest_rows(C.FEEDS["orders"], cur.raw["orders"], bool(cur.heavy("orders", "order_id"))))


def q_clean_products(spark, sf):
    return comparable(_lake(spark, sf).cur["products"])


def q_ambiguous_customers(spark, sf):
    return C.repeated_ids(_lake(spark, sf).raw["customers"]).select("customer_id")


def q_clean_customers(spark, sf):
    return comparable(_lake(spark, sf).cur["customers"])


def q_selected_payments(spark, sf):
    return comparable(_lake(spark, sf).cur["selected_payments"])


def q_clean_orders(spark, sf):
    return comparable(_lake(spark, sf).cur["orders"])


def q_quarantine_orders(spark, sf):
    return _quarantine_view(_lake(spark, sf), "orders")


def q_clean_order_lines(spark, sf):
    return comparable(_lake(spark, sf).cur["order_lines"])


def q_quarantine_products(spark, sf):
    return _quarantine_view(_lake(spark, sf), "products")


def q_quarantine_customers(spark, sf):
    return _quarantine_view(_lake(spark, sf), "customers")


def q_quarantine_order_lines(spark, sf):
    return _quarantine_view(_lake(spark, sf), "order_lines")


def q_clean_payments(spark, sf):
    return comparable(_lake(spark, sf).cur["payments"])


def q_clean_deliveries(spark, sf):
    return comparable(_lake(spark, sf).cur["deliveries"])


def q_quarantine_deliveries(spark, sf):
    return _quarantine_view(_lake(spark, sf), "deliveries")


def q_quarantine_counts(spark, sf):
    """Volume report: rows per curated table, quarantine rows per source and reason."""
    lake = _lake(spark, sf)
    parts = [
        lake.cur[t].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit("table").alias("section"), F.lit(t).alias("name"), F.lit(None).cast("string").alias("reason"),
            "row_count")
        for t in ["orders", "order_lines", "customers", "products", "payments", "deliveries"]
    ]
    q = lake.cur["quarantine"].groupBy("source", "reason").agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("quarantine").alias("section"), F.col("source").alias("name"), "reason", "row_count")
    out = q
    for p in parts:
        out = out.unionByName(p)
    return out


# ----------------------------------------------------------------------------- warehouse
def q_payments_of_retained_orders(spark, sf):
    return comparable(W.stg_payments(_lake(spark, sf).cur))


def q_lines_margin(spark, sf):
    return comparable(W.lines_enriched(_lake(spark, sf).cur))


def q_orders_enriched(spark, sf):
    return comparable(W.orders_enriched(_lake(spark, sf).cur))


def q_customer_stats(spark, sf):
    return comparable(_lake(spark, sf).customer_stats())


def q_product_stats(spark, sf):
    return comparable(_lake(spark, sf).product_stats())


def q_dim_date(spark, sf):
    return comparable(W.dim_date(spark, orders=_lake(spark, sf).cur["orders"]))


def _bounds_as_text(df: DataFrame) -> DataFrame:
    """Report form of a dimension: the open end 9999-12-31 lies outside the
    nanosecond range of pandas, so interval bounds are given as ISO text
    (the dimension itself keeps timestamps)."""
    return df.withColumns({c: F.col(c).cast("string") for c in ("valid_from", "valid_to")})


def q_dim_customer(spark, sf):
    return comparable(_bounds_as_text(_lake(spark, sf).dim_customer))


def q_dim_product(spark, sf):
    return comparable(_bounds_as_text(_lake(spark, sf).dim_product))


def q_dim_payment_method(spark, sf):
    return W.dim_payment_method(_lake(spark, sf).cur)


def q_dim_delivery_status(spark, sf):
    return W.dim_delivery_status(_lake(spark, sf).cur)


def q_fact_order_line(spark, sf):
    return comparable(_lake(spark, sf).fact())


def q_fact_asof_versions(spark, sf):
    """Every order line with the customer and product version of its order date, of several versions a key."""
    cur = _lake(spark, sf).cur
    # an order's customer version holds for its lines: they are shuffled by order and by product only
    placed = asof_ordered(cur["orders"].select("order_id", "customer_id", "order_date"), fx.customer_versions(cur["customers"]),
                          "customer_id", "customer_id", "order_date", prefix="c_", heavy=heavy_keys(cur["orders"], ["customer_id"]),
                          take=["version_no"])
    j = cur["order_lines"].select("order_line_id", "order_id", "product_id").join(
        C.joined_side(cur, "orders", placed.select("order_id", "order_date", "c_version_no")), "order_id").drop("order_id")
    j = asof_ordered(j, fx.product_versions(cur["products"]), "product_id", "product_id", "order_date", prefix="p_",
                     heavy=heavy_keys(cur["order_lines"], ["product_id"]), take=["version_no"])
    return j.select("order_line_id", F.col("c_version_no").cast("bigint").alias("customer_version"),
                    F.col("p_version_no").cast("bigint").alias("product_version"))


def q_snapshot_customers(spark, sf):
    snap = None
    for run_ts, seen in fx.customer_runs(W.stg_customers(_lake(spark, sf).cur)):
        snap = snapshot_check(snap, seen, "customer_id", W.CUSTOMER_CHECK_COLS, run_ts)
    return comparable(snap.select("customer_id", "customer_segment", "city", "birth_year", F.col(VALID_FROM).alias("valid_from"),
                                  F.col(VALID_TO).alias("valid_to")))


def q_snapshot_products(spark, sf):
    snap = None
    for seen in fx.product_runs(W.stg_products(_lake(spark, sf).cur)):
        snap = snapshot_timestamp(snap, seen, "product_id")
    return comparable(snap.select("product_id", "unit_cost", F.col(VALID_FROM).alias("valid_from"), F.col(VALID_TO).alias("valid_to")))


def q_rfm(spark, sf):
    return comparable(_lake(spark, sf).rfm())


def q_product_rotation(spark, sf):
    return comparable(_lake(spark, sf).rotation())


def q_return_rate(spark, sf):
    return comparable(_lake(spark, sf).return_rate())


def first_run_filter():
    """The earlier run of the incremental scenario: first order versions only,
    orders before the cutoff."""
    return (F.col("updated_at") == F.col("created_at")) & (F.col("order_date") < F.lit(INCREMENTAL_CUTOFF).cast(
        "timestamp"))


def q_return_rate_incremental(spark, sf):
    first = _lake(spark, sf, "first_run")
    # stored: read for its newest month and again for the rows that stay
    existing = first.stored("mart_category_return_rate", first.return_rate)
    return comparable(W.mart_category_return_rate_incremental(_lake(spark, sf).cur, existing))


# ----------------------------------------------------------------------------- scale-out windows
def q_ntile_scaleout(spark, sf):
    lines = _lake(spark, sf).raw["order_lines"].select("order_line_id", "line_total")
    out = ranking.global_ntile(lines, 5, [F.col("line_total").asc_nulls_last(), F.col("order_line_id").asc()],
                               "quintile")
    return comparable(out)


def q_running_share_scaleout(spark, sf):
    lines = _lake(spark, sf).raw["order_lines"].select("order_line_id", "line_total")
    order = [F.col("line_total").desc_nulls_first(), F.col("order_line_id").asc()]
    out = ranking.global_running_sum(lines, "line_total", order, "running_total", total_col="grand_total")
    out = out.withColumn("running_share",
                         F.try_divide(F.col("running_total").cast("double"), F.col("grand_total").cast("double")))
    return comparable(out)


# ----------------------------------------------------------------------------- events
def _events(spark, sf):
    return fx.events(spark, sf)


def q_latest_event_per_user(spark, sf):
    e = _events(spark, sf)
    return top1_by(e, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], tiebreak=False)


def q_last_purchase_per_user(spark, sf):
    e = _events(spark, sf).where(F.col("event_type") == "purchase")
    return top1_by(e, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], tiebreak=False).select(
        "user_id", F.col("event_id").alias("last_purchase_event_id"), F.col("ts").alias("last_purchase_at"),
        F.col("value").alias("last_purchase_value"))


def q_event_duplicates(spark, sf):
    """Duplicate-row counts (occurrences after the first) per key set; a
    struct makes nulls count as one value."""
    e = _events(spark, sf)
    sets = {"event_id": ["event_id"], "user_id,ts": ["user_id", "ts"],
            "user_id,event_type,value": ["user_id", "event_type", "value"]}
    parts = []
    for name, cols in sets.items():
        parts.append(e.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct(F.struct(*cols)).alias("distinct_keys"),
        ).select(F.lit(name).alias("key_columns"), "row_count", "distinct_keys",
                 (F.col("row_count") - F.col("distinct_keys")).alias("duplicate_rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def event_batches(spark, sf):
    """(previous days, last day's batch): the batch holds the last day's events
    and corrected values of every tenth earlier event."""
    e = _events(spark, sf)
    last_day = e.agg(F.to_date(F.max("ts")).alias("_day"))
    tagged = e.crossJoin(F.broadcast(last_day))  # one-row frame
    before = tagged.where(F.to_date("ts") < F.col("_day")).drop("_day")
    today = tagged.where(F.to_date("ts") >= F.col("_day")).drop("_day")
    corrections = before.where(F.col("event_id") % 10 == 0).withColumn("value", F.col("value") + F.lit(1.0))
    return before, today.unionByName(corrections)


def q_upsert_events(spark, sf):
    target, batch = event_batches(spark, sf)
    return upsert_frames(target, batch, ["event_id"])


def q_version_diff(spark, sf):
    target, batch = event_batches(spark, sf)
    v1 = upsert_frames(target, batch, ["event_id"], check_unique=False)
    return v1.exceptAll(target)


def q_scd2_history(spark, sf):
    e = _events(spark, sf).select("user_id", "ts", "event_id", "event_type")
    h = history_from_changes(e, "user_id", ["ts", "event_id"], ["event_type"])
    return h.select("user_id", "event_type", "valid_from", "valid_to",
                    F.col("version_no").cast("bigint").alias("version_no"), "is_current")


# ----------------------------------------------------------------------------- runs and stored versions
def step_events(spark, sf):
    """Step events of made pipeline runs: event i is a step of run i % 500."""
    return _events(spark, sf).selectExpr(
        "concat('run-', event_id % 500) AS run_id", "concat('dag-', event_id % 500 % 7) AS dag_id",
        "concat('day-', event_id % 500) AS logical_date", "event_type AS step",
        "CASE WHEN event_id % 231 = 0 THEN 'failed' WHEN event_id % 290 = 0 THEN 'upstream_failed' ELSE 'success' END AS state",
        "ts AS started_at", "ts + make_dt_interval(0, 0, 0, CAST(event_id % 600 AS INT)) AS ended_at", "event_id")


def _runs_shown(df):
    return df.withColumn("failed_tasks", F.array_join("failed_tasks", ","))


def q_run_state(spark, sf):
    return _runs_shown(R.run_state(step_events(spark, sf)))


def q_run_metrics(spark, sf):
    """Metrics rows of a first report, replaced by run id by a later one that saw all steps."""
    steps = step_events(spark, sf)
    cur = _lake(spark, sf).cur
    volumes = lambda runs: R.with_volumes(runs, cur["orders"], cur["quarantine"])
    first = R.record_runs(None, volumes(R.run_state(steps.where("event_id % 3 = 0 AND event_id % 500 < 400"))), "2001-08-02 07:00:00")
    return _runs_shown(R.record_runs(first, volumes(R.run_state(steps.where("event_id % 500 >= 100"))), "2001-08-02 08:00:00"))


def _event_log(spark, sf) -> ChangeLog:
    """The events in a change log: the earlier days, then the last day with its corrections."""
    cache = spark.__dict__.setdefault("_cl_event_logs", {})
    if sf not in cache:
        target, batch = event_batches(spark, sf)
        log = ChangeLog(spark, f"{ParquetStore.scratch(spark, 'events').base}/log", ["event_id"])
        log.upsert(target)
        log.upsert(batch)
        cache[sf] = log
    return cache[sf]


def q_time_travel(spark, sf):
    log = _event_log(spark, sf)
    return log.current(0).withColumn("version", F.lit(0).cast("bigint")).unionByName(
        log.current(1).withColumn("version", F.lit(1).cast("bigint")))


def q_version_changes(spark, sf):
    """Both directions between the two stored versions: rows gone and rows new."""
    return _event_log(spark, sf).changes(0, 1).withColumnRenamed("_change", "change")


def q_restore_rows(spark, sf):
    """Every twentieth event put back to its state before the newest version that touched it."""
    log = _event_log(spark, sf).compact(f"{ParquetStore.scratch(spark, 'restored').base}/log")
    before = event_batches(spark, sf)[0].where("event_id % 20 = 0")
    log.upsert(before.withColumn("value", F.col("value") - F.lit(5.0)))
    log.restore_rows(before.select("event_id"))
    return log.current()


def q_stg_quarantine(spark, sf):
    return W.stg_quarantine(_lake(spark, sf).cur)


# ----------------------------------------------------------------------------- quality & profile
def q_expectation_results(spark, sf):
    return Q.expectation_results(_lake(spark, sf).cur)


def q_relational_tests(spark, sf):
    lake = _lake(spark, sf)
    return Q.relational_tests(lake)


def q_profile_nulls(spark, sf):
    return PR.profile_nulls(_lake(spark, sf).raw)


def q_profile_anomalies(spark, sf):
    return PR.profile_anomalies(_lake(spark, sf).raw)


def q_profile_scope(spark, sf):
    return PR.profile_scope(_lake(spark, sf).raw["orders"])


def q_first_pending_delivery(spark, sf):
    """The deterministic first delivery still under way (smallest id) - the
    row a late-arrival correction is applied to.  A top-1 is the feature
    here: Spark plans it as TakeOrderedAndProject (per-task top-1, then one)."""
    d = _lake(spark, sf).cur["deliveries"]
    return comparable(d.where(F.col("delivery_status").isin("IN_TRANSIT", "OUT_FOR_DELIVERY"))
                      .orderBy(F.col("delivery_id").asc()).limit(1)
                      .select("delivery_id", "order_id", "delivery_status", "delivered_at", "delivery_delay_days",
                              "is_late"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "latest_orders": q_latest_orders,
    "clean_products": q_clean_products,
    "ambiguous_customers": q_ambiguous_customers,
    "clean_customers": q_clean_customers,
    "selected_payments": q_selected_payments,
    "clean_orders": q_clean_orders,
    "quarantine_orders": q_quarantine_orders,
    "clean_order_lines": q_clean_order_lines,
    "quarantine_products": q_quarantine_products,
    "quarantine_customers": q_quarantine_customers,
    "quarantine_order_lines": q_quarantine_order_lines,
    "clean_payments": q_clean_payments,
    "clean_deliveries": q_clean_deliveries,
    "quarantine_deliveries": q_quarantine_deliveries,
    "quarantine_counts": q_quarantine_counts,
    "payments_of_retained_orders": q_payments_of_retained_orders,
    "lines_margin": q_lines_margin,
    "orders_enriched": q_orders_enriched,
    "customer_stats": q_customer_stats,
    "product_stats": q_product_stats,
    "dim_date": q_dim_date,
    "dim_customer": q_dim_customer,
    "dim_product": q_dim_product,
    "dim_payment_method": q_dim_payment_method,
    "dim_delivery_status": q_dim_delivery_status,
    "fact_order_line": q_fact_order_line,
    "fact_asof_versions": q_fact_asof_versions,
    "snapshot_customers": q_snapshot_customers,
    "snapshot_products": q_snapshot_products,
    "rfm": q_rfm,
    "product_rotation": q_product_rotation,
    "return_rate": q_return_rate,
    "return_rate_incremental": q_return_rate_incremental,
    "ntile_scaleout": q_ntile_scaleout,
    "running_share_scaleout": q_running_share_scaleout,
    "latest_event_per_user": q_latest_event_per_user,
    "last_purchase_per_user": q_last_purchase_per_user,
    "event_duplicates": q_event_duplicates,
    "upsert_events": q_upsert_events,
    "version_diff": q_version_diff,
    "scd2_history": q_scd2_history,
    "run_state": q_run_state,
    "run_metrics": q_run_metrics,
    "time_travel": q_time_travel,
    "version_changes": q_version_changes,
    "restore_rows": q_restore_rows,
    "stg_quarantine": q_stg_quarantine,
    "expectation_results": q_expectation_results,
    "relational_tests": q_relational_tests,
    "profile_nulls": q_profile_nulls,
    "profile_anomalies": q_profile_anomalies,
    "profile_scope": q_profile_scope,
    "first_pending_delivery": q_first_pending_delivery,
}
