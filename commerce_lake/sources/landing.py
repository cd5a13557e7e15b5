"""Landing zone (raw): feeds are copied as text into Parquet, one live copy
per feed and run date, replay-safe.

* ``read_feed``   - headered UTF-8 CSV, every column text, no inference;
  required columns checked against the declared feed schema (S1).
* ``with_lineage`` - source file, ingestion time, run date (S2).
* ``land``        - a delivery is written beside what is there and made live by
  one record in the feed's manifest: a replayed run date replaces its copy and
  nothing else, an empty delivery is a valid copy (S3); the row count is observed
  on the write itself and compared with a count of the stored copy before the
  record is made (S5); the original lines are archived compressed (S4).
* ``load_audit``  - expected feeds x run dates without rows, from the manifests (S6).
* ``read_raw``    - one run date of one feed: its live copy's files alone (S7).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake.operators.manifest import Manifest
from commerce_lake.schemas import FEED_COLUMNS, FEEDS


class MissingFeedError(FileNotFoundError):
    pass


class ReconciliationError(RuntimeError):
    pass


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def check_sources(spark: SparkSession, source_dir: str, feeds: Sequence[str] = FEEDS) -> None:
    """Every expected feed file must exist; all missing names in one error."""
    missing = [f for f in feeds if not _exists(spark, f"{source_dir.rstrip('/')}/{f}.csv")]
    if missing:
        raise MissingFeedError(f"missing source files in {source_dir}: {missing}")


def read_feed(spark: SparkSession, path: str, feed: str | None = None) -> DataFrame:
    """All-text scan of a headered CSV.  With ``feed``, the declared columns
    must all be present (extra columns, such as name fields, are allowed)."""
    if not _exists(spark, path):
        raise MissingFeedError(f"source file not found: {path}")
    df = spark.read.csv(path, header=True, inferSchema=False, encoding="UTF-8", multiLine=False)
    if feed:
        absent = [c for c in FEED_COLUMNS[feed] if c not in df.columns]
        if absent:
            raise ValueError(f"{path}: required columns missing: {absent}")
    return df


def with_lineage(df: DataFrame, source_file: str, run_date: str) -> DataFrame:
    return df.withColumns({
        "_source_file": F.lit(source_file),
        "_ingested_at": F.current_timestamp(),
        "_run_date": F.lit(run_date),
    })


@dataclass
class LandingResult:
    source: str
    run_date: str
    rows_in: int
    rows_out: int
    duration_s: float
    status: str


def land(spark: SparkSession, source_dir: str, raw_root: str, feed: str, run_date: str,
         archive_root: str | None = None) -> LandingResult:
    """Copy one feed file into ``<raw_root>/<feed>/ingestion_date=<run_date>``."""
    t0 = _dt.datetime.now()
    file_name = f"{feed}.csv"
    src = f"{source_dir.rstrip('/')}/{file_name}"
    counts = {}

    def reconciled(rows_in: int, stored: DataFrame) -> None:
        counts.update(rows_in=rows_in, rows_out=stored.count())
        if counts["rows_in"] != counts["rows_out"]:
            raise ReconciliationError(f"row mismatch for {feed}: {counts['rows_in']} != {counts['rows_out']}")

    manifest(spark, raw_root, feed).write(run_date, with_lineage(read_feed(spark, src, feed), file_name, run_date), check=reconciled)
    if archive_root:
        archive(spark, src, f"{archive_root.rstrip('/')}/{feed}/{run_date}")
    return LandingResult(feed, run_date, counts["rows_in"], counts["rows_out"],
                         round((_dt.datetime.now() - t0).total_seconds(), 2), "success")


def manifest(spark: SparkSession, raw_root: str, feed: str) -> Manifest:
    return Manifest(spark, f"{raw_root.rstrip('/')}/{feed}")


def archive(spark: SparkSession, src: str, target: str) -> None:
    """Keep every line of the original file, compressed, per feed and date
    (distributed write; line content is preserved, the byte layout is not)."""
    spark.read.text(src).write.mode("overwrite").option("compression", "gzip").text(target)


def read_raw(spark: SparkSession, raw_root: str, feed: str, run_date: str) -> DataFrame:
    """One run date of a feed: the files of its live copy."""
    return manifest(spark, raw_root, feed).read(run_date)


def load_audit(spark: SparkSession, raw_root: str, run_dates: Sequence[str],
               feeds: Sequence[str] = FEEDS) -> DataFrame:
    """Expected (feed, run date) pairs with their landed row counts; a
    missing pair shows 0 rows and ``landed`` false.  Reads the manifests only."""
    expected = spark.createDataFrame([(f, d) for f in feeds for d in run_dates], "feed string, run_date string")
    landed = None
    for f in feeds:
        c = manifest(spark, raw_root, f).records().select(F.lit(f).alias("feed"), F.col("key").alias("run_date"), "rows")
        landed = c if landed is None else landed.unionByName(c)
    out = expected.join(landed, ["feed", "run_date"], "left")
    return out.select("feed", "run_date", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), F.col("rows").isNotNull().alias("landed"))
