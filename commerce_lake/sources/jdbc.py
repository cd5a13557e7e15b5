"""Relational sink: full reload of a table over JDBC (truncate + batched
insert), then a read-back count.

The writer keeps the target table (``truncate``) and sends rows in batches over
as many connections as the target is said to take.  The rows are dealt to that
many tasks by an exchange, so the stage before it keeps its own parallelism
(coalescing would narrow it to the connections)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class JdbcTarget:
    url: str
    properties: dict
    max_connections: int  # the database's limit: there is no default that fits all
    batch_size: int = 5000

    def __post_init__(self):
        if self.max_connections < 1:
            raise ValueError("a reload needs a connection")


def reload_table(df: DataFrame, target: JdbcTarget, table: str) -> None:
    """Replace the rows of ``table`` (created on first use)."""
    (df.repartition(target.max_connections).write.mode("overwrite")
     .option("truncate", "true")
     .option("batchsize", str(target.batch_size))
     .option("numPartitions", str(target.max_connections))
     .option("isolationLevel", "READ_COMMITTED")
     .jdbc(target.url, table, properties=target.properties))


def count_rows(spark: SparkSession, target: JdbcTarget, table: str) -> int:
    return spark.read.jdbc(target.url, table, properties=target.properties).count()


def reload_all(spark: SparkSession, tables: dict[str, DataFrame], target: JdbcTarget,
               schema: str | None = None) -> dict[str, int]:
    """Reload every table and return the read-back counts."""
    out = {}
    for name, df in tables.items():
        full = f"{schema}.{name}" if schema else name
        reload_table(df, target, full)
        out[name] = count_rows(spark, target, full)
    return out
