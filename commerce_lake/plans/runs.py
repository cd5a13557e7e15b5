"""Run bookkeeping: run state, metrics rows kept by run id, volume report.

Everything is a DataFrame over a step-event table (one row per step of a
run: run_id, dag_id, logical_date, step, state, started_at, ended_at), so
all runs are summarised by one ``groupBy(run_id)`` instead of one query per
run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake.operators.upsert import upsert_frames

FAILED_STATES = ["failed", "upstream_failed"]

# Columns replaced when a run id is recorded again; dag_id, logical_date and
# started_at keep their first value.
UPDATED_ON_CONFLICT = ["state", "ended_at", "duration_s", "failed_tasks", "orders_count", "quarantine_count",
                       "recorded_at"]


def run_state(steps: DataFrame) -> DataFrame:
    """Per run: failed if any step failed or was upstream_failed; the sorted
    distinct list of such steps; start and end times and duration."""
    failed = F.array_sort(F.collect_set(F.when(F.col("state").isin(*FAILED_STATES), F.col("step"))))
    g = steps.groupBy("run_id").agg(
        F.first("dag_id", ignorenulls=True).alias("dag_id"),
        F.first("logical_date", ignorenulls=True).alias("logical_date"),
        failed.alias("failed_tasks"),
        F.min("started_at").alias("started_at"),
        F.max("ended_at").alias("ended_at"),
    )
    return g.select(
        "run_id", "dag_id", "logical_date",
        F.when(F.size("failed_tasks") > 0, F.lit("failed")).otherwise(F.lit("success")).alias("state"),
        "started_at", "ended_at",
        (F.unix_micros("ended_at") - F.unix_micros("started_at")).cast("double").alias("_us"),
        "failed_tasks",
    ).withColumn("duration_s", F.col("_us") / F.lit(1e6)).drop("_us")


def with_volumes(runs: DataFrame, orders: DataFrame | None, quarantine: DataFrame | None) -> DataFrame:
    """Add curated volumes (null when a table does not exist yet)."""
    o = orders.agg(F.count(F.lit(1)).alias("orders_count")) if orders is not None else None
    q = quarantine.agg(F.count(F.lit(1)).alias("quarantine_count")) if quarantine is not None else None
    out = runs
    out = out.crossJoin(o) if o is not None else out.withColumn("orders_count", F.lit(None).cast("long"))
    out = out.crossJoin(q) if q is not None else out.withColumn("quarantine_count", F.lit(None).cast("long"))
    return out


def record_runs(existing: DataFrame | None, runs: DataFrame, recorded_at: str) -> DataFrame:
    """Upsert metrics rows by run_id: on a repeat only the state, end,
    duration, failed list, volumes and record time change."""
    rows = runs.withColumn("recorded_at", F.lit(recorded_at).cast("timestamp"))
    if existing is None:
        return rows
    return upsert_frames(existing, rows.select(*existing.columns), ["run_id"], update_cols=UPDATED_ON_CONFLICT)


def volume_report(tables: dict[str, DataFrame], quarantine: DataFrame) -> DataFrame:
    """Rows per table, then quarantine rows per source and reason, ordered."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("table").alias("section"), F.lit(n).alias("name"), F.lit(None).cast("string").alias("reason"),
        "row_count") for n, df in tables.items()]
    q = quarantine.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("quarantine").alias("section"), F.col("source").alias("name"), "reason", "row_count")
    out = q
    for p in parts:
        out = out.unionByName(p)
    return out.orderBy("section", "name", "reason")


def write_summary(df: DataFrame, path: str) -> None:
    """Result tables (quality, profile, volumes) as JSON."""
    df.write.mode("overwrite").json(path)
