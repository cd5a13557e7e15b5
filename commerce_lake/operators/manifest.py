"""Which attempt of each key is live: stored tables that are replaced whole.

A write goes to a folder of its own (``data/<key>/<attempt>``); one appended
record then makes it live, with its row count, its schema and a note.  Readers
take the newest record, so a crash before the record leaves the table as it was,
a reader never meets a half-written or missing table, an empty attempt is a
valid one, and row counts need no scan.  Superseded and lost attempts stay until
``purge``.  One writer at a time.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_lake.session import remove_path

_RECORD = "seq long, key string, attempt string, rows long, columns string, note string, committed_at timestamp"


class Manifest:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _records(self) -> DataFrame:
        fs, p = self._fs(f"{self.path}/_commits")
        if not fs.exists(p):
            return self.spark.createDataFrame([], _RECORD)
        return self.spark.read.schema(_RECORD).parquet(f"{self.path}/_commits")

    def records(self) -> DataFrame:
        """The live record of each key."""
        newest = F.max_by(F.struct("seq", "attempt", "rows", "columns", "note", "committed_at"), "seq").alias("r")
        return self._records().groupBy("key").agg(newest).select("key", "r.*")

    def live(self, key: str) -> Row | None:
        return self.records().where(F.col("key") == key).first()

    def _data(self, key: str, attempt: str) -> str:
        return f"{self.path}/data/{re.sub('[^A-Za-z0-9_.=-]', '_', key)}/{attempt}"

    def read(self, key: str) -> DataFrame:
        row = self.live(key)
        if row is None:
            raise FileNotFoundError(f"{self.path}: nothing is committed for {key}")
        schema = T.StructType.fromJson(json.loads(row["columns"]))
        return self.spark.read.schema(schema).parquet(self._data(key, row["attempt"]))

    def write(self, key: str, df: DataFrame, note: dict | None = None, check=None) -> DataFrame:
        """Stores ``df`` as the key's live attempt.  ``check(rows written, stored frame)`` may raise, and nothing changes."""
        attempt = f"a{uuid.uuid4().hex}"
        obs = Observation(f"rows_{attempt}")
        path = self._data(key, attempt)
        df.observe(obs, F.count(F.lit(1)).alias("n")).write.parquet(path)
        rows = int(obs.get.get("n", 0) or 0)
        stored = self.spark.read.schema(df.schema).parquet(path)
        if check:
            check(rows, stored)
        seq = self._records().agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0] + 1
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        self.spark.createDataFrame([(seq, key, attempt, rows, df.schema.json(), json.dumps(note or {}), now)], _RECORD).coalesce(
            1).write.mode("append").parquet(f"{self.path}/_commits")
        return stored

    def note(self, key: str) -> dict:
        row = self.live(key)
        return json.loads(row["note"]) if row else {}

    def purge(self, keep: Sequence[str] = ()) -> int:
        """Removes the folders of all attempts but the live ones (and those in ``keep``); returns how many."""
        live = {(r["key"], r["attempt"]) for r in self.records().select("key", "attempt").collect()}  # a row a key
        wanted = {self._data(k, a) for k, a in live}
        fs, p = self._fs(f"{self.path}/data")
        gone = 0
        if fs.exists(p):
            for key in fs.listStatus(p):
                for a in fs.listStatus(key.getPath()):
                    name = a.getPath().getName()
                    if name not in keep and not any(w.endswith(f"/{key.getPath().getName()}/{name}") for w in wanted):
                        remove_path(self.spark, a.getPath().toString())
                        gone += 1
        return gone
