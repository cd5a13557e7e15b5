"""Retail lakehouse on Spark: landing, curated tables with quarantine and keyed
upserts, type-2 dimensions, an as-of joined fact table, three marts, quality
checks and a profile - all as DataFrame / Spark SQL plans.

Layout:
    sources/    feed scans, landing zone, fixture mapping, JDBC sink
    functions/  column-expression helpers (typed projection, keys, dates)
    operators/  reusable DataFrame operators (latest row, upsert, change log,
                type-2 snapshots, as-of join, scale-out global windows)
    plans/      the domain pipelines (curated, staging, marts, quality, profile, runs)
    streaming/  foreachBatch hook that applies keyed upserts to a stream
"""

__all__ = ["session"]
