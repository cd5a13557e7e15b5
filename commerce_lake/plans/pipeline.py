"""Curated run (D9): the curated zone built, stored and handed to its consumers.

``ParquetStore`` writes plain Parquet folders, each name once per run in a fresh
folder; the classified rows of a feed lie there, accepted and rejected ones in
partitions of one table.  ``run_curated`` takes a second store for the curated
tables themselves: ``ChangeLogStore`` upserts them into versioned change logs
(replays of the same run date add nothing), after which the run's own folder is
removed.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from commerce_lake.operators.upsert import ChangeLog
from commerce_lake.plans.curated import CURATED, CuratedZone
from commerce_lake.session import ensure_checkpoint_dir, remove_path, shuffles_removed

PARTITIONS = {"orders": ["order_year_month"], "order_lines": ["order_year_month"], "quarantine": ["source"]}
KEYS = {
    "products": ["product_id"], "customers": ["customer_id"], "selected_payments": ["order_id"],
    "orders": ["order_id"], "order_lines": ["order_line_id"], "payments": ["payment_id"],
    "deliveries": ["delivery_id"], "quarantine": ["source", "record_key", "reason", "payload"],
}

@dataclass
class ParquetStore:
    spark: SparkSession
    base: str
    written: dict = field(default_factory=dict)

    @classmethod
    def scratch(cls, spark: SparkSession, label: str = "curated") -> "ParquetStore":
        """A fresh folder under the session's checkpoint directory (the shared
        folder of the cluster; a test session gets its own)."""
        root = ensure_checkpoint_dir(spark).rstrip("/")
        return cls(spark, f"{root}/{label}-{uuid.uuid4().hex[:12]}")

    def __call__(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        return self.slices(name, [df], partition_by)

    def slices(self, name: str, frames: Iterable[DataFrame], partition_by: list[str] | None = None) -> DataFrame:
        """The rows of all frames, one written after the other: only one frame's shuffle files exist at a time."""
        path = f"{self.base}/{name}"
        t0 = time.time()
        for i, df in enumerate(frames):
            with shuffles_removed(self.spark):
                self._write(path, df, partition_by, "append" if i else "errorifexists")
        self.written[name] = round(time.time() - t0, 3)
        # the types are known: nothing is inferred from folder names or files
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def _write(self, path: str, df: DataFrame, partition_by: list[str] | None, mode: str) -> None:
        # rows are written by the task that made them, without a shuffle of their own.  The
        # first partition column makes folders, the others an order inside each file:
        # their ranges per row group let a read of few months skip the rest, and
        # a task writes few files however many months its rows are of
        w = (df.sortWithinPartitions(*partition_by) if partition_by else df).write.mode(mode).option(
            "compression", "zstd")
        if partition_by:
            w = w.partitionBy(partition_by[0])
        w.parquet(path)

    def remove(self) -> None:
        """Deletes the folder, when no reader is left."""
        remove_path(self.spark, self.base)


@dataclass
class ChangeLogStore:
    spark: SparkSession
    base: str

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        log = ChangeLog(self.spark, f"{self.base}/{name}", KEYS[name], PARTITIONS.get(name))
        src = df.dropDuplicates(KEYS[name]) if name == "quarantine" else df
        log.upsert(src)
        return log.current().select(*df.columns)


def run_curated(raw: dict[str, DataFrame], salt: str, run_date: str, store: ChangeLogStore,
                strict_amounts: bool = False) -> dict[str, DataFrame]:
    """Every curated table, upserted into ``store``; returns the stored frames."""
    scratch = ParquetStore.scratch(store.spark)
    zone = CuratedZone(raw, salt, run_date, scratch, strict_amounts)
    try:
        return {name: store(name, zone[name]) for name in CURATED}
    finally:
        scratch.remove()
