"""Scale-out global windows: row number, ntile and running sum over a total
order without pulling every row into one task.

A window with ORDER BY and no PARTITION BY plans an ``Exchange
SinglePartition``: all rows go through one task.  Here instead:

1. ``repartitionByRange(n, order)`` - Spark samples the key distribution and
   splits it into ``n`` contiguous ranges (the order ends in a unique key, so
   even a value shared by a third of the rows is split across ranges);
2. ``sortWithinPartitions(order)`` and ``monotonically_increasing_id`` give
   each row its partition id and its position inside the partition - plain
   JVM expressions in the same stage, no extra shuffle;
3. a per-partition aggregate (``n`` rows: count, sum) is turned into prefix
   offsets and broadcast back - its size is bounded by ``n``, not by the data.

``n``, the number of ranges, is a parameter of every operator (default
``spark.sql.shuffle.partitions``): one range is sorted by one task, so a job
sets it to the input's size over the size a task should sort.

The positioned rows are checkpointed once (reliable checkpoint), so the
per-partition stats and the rows read the very same partitions.  The order
must be total (end in a unique column) for the result to be deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commerce_lake.operators.skew import Sliced
from commerce_lake.session import ensure_checkpoint_dir, shuffle_partitions, shuffles_removed

_LOW33 = (1 << 33) - 1


def _positioned(df: DataFrame, order: Sequence[Column], n: int | None) -> DataFrame:
    """Rows with their range partition (``_pid``) and position in it (``_pos``).

    The result is checkpointed (reliable, in ``spark.checkpoint.dir``): the
    per-partition stats and the rows must see the *same* partitions, and two
    independently planned range exchanges over an input whose row order is
    not fixed (any shuffle output) may sample different bounds.  Reading one
    stored copy makes both consistent, also after a lost executor."""
    n = n or shuffle_partitions(df.sparkSession)
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    mid = F.monotonically_increasing_id()
    with shuffles_removed(df.sparkSession):  # the frame is made inside, too: it takes the setting along
        pos = ranged.select(
            "*",
            F.shiftright(mid, 33).alias("_pid"),
            (mid.bitwiseAND(F.lit(_LOW33)) + F.lit(1)).alias("_pos"),
        )
        return pos.checkpoint(eager=True)


def _offsets(stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Prefix sums over the per-partition stats (one row per range partition)."""
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = stats
    for c in cols:
        out = out.withColumn(f"{c}_off", F.coalesce(F.sum(c).over(before), F.lit(0)))
        out = out.withColumn(f"{c}_all", F.sum(c).over(every))
    return out


def global_row_number(df: DataFrame, order: Sequence[Column], out_col: str = "row_number", n: int | None = None,
                      total_col: str | None = None) -> DataFrame:
    """``row_number() OVER (ORDER BY order)`` without a single partition."""
    pos = _positioned(df, order, n)
    stats = pos.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offs = _offsets(stats, ["_cnt"]).select("_pid", "_cnt_off", "_cnt_all")
    out = pos.join(F.broadcast(offs), "_pid").withColumn(out_col, F.col("_cnt_off") + F.col("_pos"))
    if total_col:
        out = out.withColumn(total_col, F.col("_cnt_all"))
    return out.drop("_pid", "_pos", "_cnt_off", "_cnt_all")


def ntile_from_rank(rank: Column, total: Column, k: int) -> Column:
    """ntile(k) from a 1-based rank among ``total`` rows: the first N mod k
    tiles hold one row more.  Divisors never reach 0 (ANSI would raise)."""
    q = F.floor(total / F.lit(k))
    m = total - q * F.lit(k)
    big = m * (q + 1)
    first = F.floor((rank - 1) / (q + 1)) + 1
    rest = m + F.floor((rank - 1 - big) / F.greatest(q, F.lit(1))) + 1
    return F.when(rank <= big, first).otherwise(rest).cast("int")


def global_ntile(df: DataFrame, k: int, order: Sequence[Column], out_col: str, n: int | None = None) -> DataFrame:
    """``ntile(k) OVER (ORDER BY order)`` without a single partition."""
    ranked = global_row_number(df, order, "_gr", n, total_col="_gn")
    return ranked.withColumn(out_col, ntile_from_rank(F.col("_gr"), F.col("_gn"), k)).drop("_gr", "_gn")


def global_running_sum(df: DataFrame, value: str, order: Sequence[Column], out_col: str,
                       total_col: str | None = None, n: int | None = None) -> DataFrame:
    """``sum(value) OVER (ORDER BY order ROWS UNBOUNDED PRECEDING)`` (equal to
    the RANGE frame when the order is total) without a single partition.

    All sums are 38-digit decimals: inside a range a window over its id and
    position, plus the exact sum of the ranges before.  A result that does not
    fit raises, it never wraps."""
    dtype = dict(df.dtypes)[value]
    if dtype.startswith("decimal"):
        out_type = f"decimal(38,{dtype.split(',')[1].rstrip(')')})"
        exact = out_type
    elif dtype in ("int", "bigint", "smallint", "tinyint"):
        out_type, exact = "bigint", "decimal(38,0)"
    else:
        raise TypeError(f"running sum needs an exact type, got {dtype}")
    pos = _positioned(df, order, n)
    held = F.col(value).cast(exact)
    stats = pos.groupBy("_pid").agg(F.sum(held).alias("_sum"), F.count(value).alias("_nnc"))
    offs = _offsets(stats, ["_sum", "_nnc"]).select("_pid", "_sum_off", "_sum_all", "_nnc_off")
    so_far = Window.partitionBy("_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    out = pos.withColumn("_lcum", F.sum(held).over(so_far)).join(F.broadcast(offs), "_pid")
    # null until the first non-null value in the global order, as in SQL
    running = F.when(
        (F.col("_nnc_off") > 0) | F.col("_lcum").isNotNull(),
        (F.col("_sum_off").cast(exact) + F.coalesce(F.col("_lcum"), F.lit(0).cast(exact))).cast(out_type),
    )
    out = out.withColumn(out_col, running)
    if total_col:
        out = out.withColumn(total_col, F.col("_sum_all").cast(out_type))
    return out.drop("_pid", "_pos", "_lcum", "_sum_off", "_sum_all", "_nnc_off")


def naive_ntile(df: DataFrame, k: int, order: Sequence[Column], out_col: str) -> DataFrame:
    """Reference form (single partition) - for tests and the bench only."""
    return df.withColumn(out_col, F.ntile(k).over(Window.orderBy(*order)))


def naive_running_sum(df: DataFrame, value: str, order: Sequence[Column], out_col: str) -> DataFrame:
    """Reference form (single partition) - for tests and the bench only."""
    return df.withColumn(out_col, F.sum(value).over(Window.orderBy(*order)))


def row_number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], out_col: str) -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order)`` (ascending) for
    keys that may be hot: one window whose heavy keys are cut into slices."""
    s = Sliced.of(df, keys, order).number(out_col)
    return s.select(*df.columns, out_col)


def neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``lag`` / ``lead`` of ``cols`` within ``keys`` (``prev_<c>``,
    ``next_<c>``, plus ``is_first``), heavy keys in slices: one exchange and
    one sort, border rows handed on between the slices of a key."""
    held = F.struct(*[F.col(c) for c in cols])
    s = Sliced.of(df, keys, order).before(held, "__prev").after(held, "__next")
    return s.select(*df.columns, *[F.col(f"__prev.v.{c}").alias(f"prev_{c}") for c in cols],
                    *[F.col(f"__next.v.{c}").alias(f"next_{c}") for c in cols], F.col("__prev").isNull().alias("is_first"))
