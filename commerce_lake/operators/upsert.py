"""Keyed upsert (MERGE semantics without a table format).

``upsert_frames`` is the pure DataFrame form: null-safe key match, update all
(or a column list), insert all.  It is a left-anti join plus a union, so it
costs one shuffle of each side on the key; AQE turns it into a broadcast join
at run time when the measured source is small, and splits a skewed key.

``ChangeLog`` is the stored form used by the curated zone: an append-only
Parquet log partitioned by ``_version``.  An upsert appends only the source
rows that are new or differ from the current row of their key; the current
state is the newest committed version per key.  Time travel is a partition
filter on ``_version``, history is the commit table, restore re-appends old
rows.  Nothing is deleted, as with the MERGE it replaces (matched rows are
updated, unmatched target rows stay).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


from commerce_lake.session import remove_path


class DuplicateKeyError(ValueError):
    pass


def assert_unique_keys(df: DataFrame, keys: Sequence[str], sample: int = 5) -> None:
    """Fail when a key occurs more than once in an upsert source.  Returns at
    most ``sample`` offending keys to the driver."""
    dups = df.groupBy(*keys).count().where(F.col("count") > 1).limit(sample).collect()
    if dups:
        shown = ", ".join(str(tuple(r[k] for k in keys)) for r in dups)
        raise DuplicateKeyError(f"upsert source has repeated keys {list(keys)}: {shown}")


def _ns_cond(left: str, right: str, keys: Sequence[str]):
    cond = None
    for k in keys:
        c = F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
        cond = c if cond is None else cond & c
    return cond


def upsert_frames(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    insert: bool = True,
    check_unique: bool = True,
) -> DataFrame:
    """MERGE ``source`` into ``target`` on ``keys`` (null-safe).

    ``update_cols=None`` replaces matched rows whole; with a list, matched rows
    take only those columns from the source and keep the rest.  ``insert``
    adds unmatched source rows.  Column order follows ``target``."""
    keys = list(keys)
    if check_unique:
        assert_unique_keys(source, keys)
    cols = target.columns
    src = source.select(*cols)
    t, s = target.alias("t"), src.alias("s")
    kept = t.join(s, _ns_cond("t", "s", keys), "left_anti")
    if update_cols is None and insert:
        return kept.unionByName(src)
    parts = [kept]
    if update_cols is None:
        parts.append(s.join(t, _ns_cond("s", "t", keys), "left_semi"))
    else:
        upd = set(update_cols)
        matched = s.join(t, _ns_cond("s", "t", keys), "inner").select(
            *[(F.col(f"s.{c}") if c in upd or c in keys else F.col(f"t.{c}")).alias(c) for c in cols]
        )
        parts.append(matched)
        if insert:
            parts.append(s.join(t, _ns_cond("s", "t", keys), "left_anti"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ----------------------------------------------------------------------------- stored form
_COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType(), False),
        T.StructField("committed_at", T.TimestampType(), False),
        T.StructField("operation", T.StringType(), False),
        T.StructField("rows_written", T.LongType(), False),
        T.StructField("attempt", T.StringType(), False),
    ]
)


class ChangeLog:
    """Append-only versioned table keyed by ``keys``.

    Layout: ``<path>/data`` (Parquet, partitioned by ``_version``, ``_attempt``
    and any ``partition_by`` columns), ``<path>/_files`` (one row per file with
    the range of its first key) and ``<path>/_commits`` (one row per committed
    version, with the attempt that made it).  Every append writes under a fresh
    attempt id, and readers take exactly the attempts that were committed, so
    rows of a failed append stay invisible whatever its retry writes.  Rows are
    laid down in key order, so an upsert of few keys opens the files whose ranges
    it touches.  ``compact_in_place`` starts a new base version by one commit;
    ``vacuum`` then removes what is older, and lost attempts.  One writer at a
    time."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], partition_by: Sequence[str] | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.partition_by = list(partition_by or [])

    # -- metadata
    @property
    def data_path(self) -> str:
        return f"{self.path}/data"

    @property
    def commits_path(self) -> str:
        return f"{self.path}/_commits"

    @property
    def files_path(self) -> str:
        return f"{self.path}/_files"

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _exists(self, path: str | None = None) -> bool:
        fs, p = self._fs(path or self.commits_path)
        return fs.exists(p)

    def history(self) -> DataFrame:
        """Committed versions: version, committed_at, operation, rows_written, attempt."""
        if not self._exists():
            return self.spark.createDataFrame([], _COMMIT_SCHEMA)
        return self.spark.read.schema(_COMMIT_SCHEMA).parquet(self.commits_path)

    def recent_versions(self, n: int = 15) -> DataFrame:
        """The newest ``n`` committed versions, newest first (a top-n report)."""
        return self.history().orderBy(F.col("version").desc()).limit(n)

    def latest_version(self) -> int | None:
        row = self.history().agg(F.max("version").alias("v")).first()
        return None if row is None or row["v"] is None else int(row["v"])

    # -- reads
    def _committed(self, as_of_version: int | None = None) -> DataFrame:
        """version and attempt of the commits that a reader needs: from the newest compaction on."""
        commits = self.history()
        if as_of_version is not None:
            commits = commits.where(F.col("version") <= F.lit(as_of_version))
        base = commits.where("operation = 'COMPACT'").agg(F.coalesce(F.max("version"), F.lit(0)).alias("base"))
        return commits.crossJoin(F.broadcast(base)).where("version >= base").select("version", "attempt")  # base: one row

    def _files_of(self, keys: DataFrame, committed: DataFrame) -> list[str] | None:
        """Paths of the committed files whose key range meets that of ``keys``; None where all do."""
        if not self._exists(self.files_path):
            return None
        k = self.keys[0]
        low, high = keys.agg(F.min(k), F.max(k)).first()
        files = self.spark.read.parquet(self.files_path).join(committed, ["version", "attempt"], "left_semi")
        # a null key lies in no range: files that hold one are always read
        meets = F.col("nulls") > 0
        if low is not None:
            meets = meets | ((F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low)))
        rows = files.select("version", "file", F.coalesce(meets, F.lit(False)).alias("meets")).collect()  # a row a file
        written = self.history().where("rows_written > 0").join(committed, ["version", "attempt"], "left_semi")
        if {r["version"] for r in written.select("version").collect()} - {r["version"] for r in rows}:
            return None  # an append without its files noted
        return None if all(r["meets"] for r in rows) else [r["file"] for r in rows if r["meets"]]

    def _committed_rows(self, as_of_version: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        committed = self._committed(as_of_version)
        data = self.spark.read.parquet(self.data_path)
        files = None if keys is None else self._files_of(keys, committed)
        if files is not None:
            read = self.spark.read.schema(data.schema).option("basePath", self.data_path)
            data = read.parquet(*files) if files else data.where(F.lit(False))
        if as_of_version is not None:
            data = data.where(F.col("_version") <= F.lit(as_of_version))
        committed = committed.select(F.col("version").alias("_version"), F.col("attempt").alias("_attempt"))
        # one row per committed version; AQE broadcasts it after measuring it
        return data.join(committed, ["_version", "_attempt"], "left_semi").drop("_attempt")

    def current(self, as_of_version: int | None = None, with_version: bool = False,
                keys_of: DataFrame | None = None) -> DataFrame:
        """State of the table (newest committed row per key) at a version.
        With ``keys_of``, only the keys present there (null-safe) are
        resolved: an upsert that touches a few keys does not sort the table."""
        rows = self._committed_rows(as_of_version, keys_of)
        if keys_of is not None:
            k = keys_of.select(*self.keys).distinct()
            rows = rows.alias("r").join(k.alias("k"), _ns_cond("r", "k", self.keys), "left_semi")
        w = Window.partitionBy(*self.keys).orderBy(F.col("_version").desc())
        cur = rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
        return cur if with_version else cur.drop("_version")

    def _touched(self, new_version: int, old_version: int) -> DataFrame:
        """Keys with a committed row after ``old_version`` up to ``new_version``."""
        return self._committed_rows(new_version).where(F.col("_version") > old_version).select(*self.keys).distinct()

    def diff(self, new_version: int, old_version: int) -> DataFrame:
        """Rows present at ``new_version`` and not at ``old_version`` (multiset).
        Only keys touched in between can differ, so only those are resolved."""
        keys = self._touched(max(new_version, old_version), min(new_version, old_version))
        return self.current(new_version, keys_of=keys).exceptAll(self.current(old_version, keys_of=keys))

    def changes(self, old_version: int, new_version: int) -> DataFrame:
        """Both directions: rows gone since ``old_version`` and rows new at ``new_version`` (``_change``)."""
        return (self.diff(old_version, new_version).withColumn("_change", F.lit("removed"))
                .unionByName(self.diff(new_version, old_version).withColumn("_change", F.lit("added"))))

    # -- writes
    def _commit(self, version: int, operation: str, rows: int, attempt: str) -> None:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        self.spark.createDataFrame([(version, now, operation, rows, attempt)], _COMMIT_SCHEMA).coalesce(1).write.mode(
            "append"
        ).parquet(self.commits_path)

    def _append(self, rows: DataFrame, operation: str) -> int:
        last = self.latest_version()
        version = 0 if last is None else last + 1
        attempt = f"a{uuid.uuid4().hex}"  # a letter first: never read as a number
        obs = Observation(f"append_{attempt}")
        out = rows.withColumn("_version", F.lit(version).cast("long")).withColumn("_attempt", F.lit(attempt))
        if self.partition_by:  # whole partitions per task, sized and split by AQE
            out = out.hint("rebalance", *self.partition_by)
        else:  # near keys in one file
            out = out.repartitionByRange(*self.keys)
        # the row count rides along with the write (no second job)
        (out.sortWithinPartitions(*self.partition_by, *self.keys).observe(obs, F.count(F.lit(1)).alias("n"))
         .write.mode("append").partitionBy("_version", "_attempt", *self.partition_by).parquet(self.data_path))
        n = int(obs.get.get("n", 0) or 0)
        if n:
            self._note_files(version, attempt)
        self._commit(version, operation, n, attempt)
        return version

    def _note_files(self, version: int, attempt: str) -> None:
        """The key ranges of an append's files: a read of their first key column."""
        k = F.col(self.keys[0])
        rows = (self.spark.read.option("basePath", self.data_path).parquet(f"{self.data_path}/_version={version}/_attempt={attempt}")
                .groupBy(F.input_file_name().alias("file")).agg(F.min(k).alias("low"), F.max(k).alias("high"), F.count_if(k.isNull()).alias("nulls")))
        decoded = F.expr("url_decode(replace(file, '+', '%2B'))")  # input_file_name encodes the path
        (rows.select(F.lit(version).cast("long").alias("version"), F.lit(attempt).alias("attempt"), decoded.alias("file"), "low", "high", "nulls")
         .coalesce(1).write.mode("append").parquet(self.files_path))

    def upsert(self, source: DataFrame, operation: str = "MERGE", check_unique: bool = True) -> int:
        """MERGE ``source`` (update all / insert all).  Appends only rows that
        are new or changed; returns the committed version."""
        if check_unique:
            assert_unique_keys(source, self.keys)
        if not self._exists():
            return self._append(source, "CREATE" if operation == "MERGE" else operation)
        cur = self.current(keys_of=source)
        src = source.select(*cur.columns)
        # lineage columns (``_``-prefixed: ingestion time, source file) do not
        # make a row new: replaying identical business data appends nothing
        business = [c for c in src.columns if not c.startswith("_")]
        changed = src.alias("s").join(cur.alias("c"), _ns_cond("s", "c", business), "left_anti")
        return self._append(changed, operation)

    def update_only(self, source: DataFrame, operation: str = "RESTORE") -> int:
        """MERGE with only WHEN MATCHED UPDATE: rows whose key is absent stay out."""
        cur = self.current(keys_of=source)
        src = source.select(*cur.columns).alias("s")
        matched = src.join(cur.alias("c"), _ns_cond("s", "c", self.keys), "left_semi")
        business = [c for c in cur.columns if not c.startswith("_")]
        changed = matched.alias("s").join(cur.alias("c"), _ns_cond("s", "c", business), "left_anti")
        return self._append(changed, operation)

    def restore_rows(self, key_rows: DataFrame, to_version: int | None = None) -> int:
        """Put back the ``to_version`` state of the given keys; by default the
        state before the newest version that touched one of them."""
        keys = key_rows.select(*self.keys)
        if to_version is None:
            touched = self._committed_rows().alias("r").join(
                keys.distinct().alias("k"), _ns_cond("r", "k", self.keys), "left_semi").agg(F.max("_version")).first()[0]
            if not touched:
                raise ValueError("the keys have no version before their newest one")
            to_version = int(touched) - 1
        return self.update_only(self.current(to_version, keys_of=keys))

    def compact_in_place(self) -> int:
        """Appends the current state as a version that readers start from; older versions stay until ``vacuum``."""
        return self._append(self.current(), "COMPACT")

    def vacuum(self) -> int:
        """Removes appends that no reader of the newest state needs and appends that were never committed."""
        keep = {(r["version"], r["attempt"]) for r in self._committed().collect()}  # a row a version
        fs, p = self._fs(self.data_path)
        gone = 0
        for v in fs.listStatus(p):
            name = v.getPath().getName()
            if not name.startswith("_version="):
                continue
            version, left = int(name.split("=")[1]), 0
            for a in fs.listStatus(v.getPath()):
                attempt = a.getPath().getName().split("=")[-1]
                if (version, attempt) in keep:
                    left += 1
                else:
                    remove_path(self.spark, a.getPath().toString())
                    gone += 1
            if not left:
                remove_path(self.spark, v.getPath().toString())
        return gone

    def compact(self, new_path: str) -> "ChangeLog":
        """Write the current state to a new base path as version 0."""
        nxt = ChangeLog(self.spark, new_path, self.keys, self.partition_by)
        nxt._append(self.current(), "COMPACT")
        return nxt
