"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from commerce_lake.session import ensure_checkpoint_dir


class Scratch:
    """A fresh folder under ``spark.checkpoint.dir``.

    ``store`` writes a frame once and returns the frame that reads it back: the
    lineage is cut, a lost executor costs a read and not a recomputation, and
    joins start from a table of known size.  Tables whose last reader is done
    are removed with ``drop``; the ones a lazy result still reads stay.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            if path := getattr(df, "_scratch_path", None):
                jvm = self.spark.sparkContext._jvm
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
