"""Type-2 history.

* ``snapshot_check`` / ``snapshot_timestamp`` apply one run to a stored
  snapshot (check strategy: any listed column changed, null-safe;
  timestamp strategy: ``updated_at`` advanced).  Changed keys get their open
  row closed and a new row opened; new keys are inserted; keys absent from
  the run stay open (no hard deletes).  One full outer join of the open rows
  with the run on the key, whose pairs become one or two rows; a key that the
  run repeats raises.
* ``history_from_changes`` builds the same intervals in one pass from many
  observations (backfill): keep rows whose tracked values differ from the
  previous observation of the key, close each with the next kept row's
  start.  One exchange and one sort; heavy keys are cut into slices.
* ``dimension_view`` turns a snapshot into a dimension: version number,
  back-dated first version, open end, current flag, md5 surrogate key.

The run timestamp is always a parameter, so a replayed run gives identical
rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.functions.expr import md5_key
from commerce_lake.operators.skew import Sliced
from commerce_lake.schemas import OPEN_END, OPEN_START

VALID_FROM = "snapshot_valid_from"
VALID_TO = "snapshot_valid_to"
UPDATED = "snapshot_updated_at"


def _apply(snapshot: DataFrame | None, run: DataFrame, key: str, new_from: Column, changed) -> DataFrame:
    """``changed(old, new)``: whether a pair opens a new version; ``old`` and ``new`` name a side's columns."""
    opened = run.withColumns({VALID_FROM: new_from, VALID_TO: F.lit(None).cast("timestamp"), UPDATED: new_from})
    # a row a key; the aggregate's exchange on the key is the join's as well
    new = opened.groupBy(key).agg(F.first(F.struct(*opened.columns)).alias("n"), F.count(F.lit(1)).alias("times")).select(
        key, F.when(F.col("times") > 1, F.raise_error(F.concat(F.lit(f"the run repeats {key} "), F.col(key).cast("string"))))
        .otherwise(F.col("n")).alias("n"))
    if snapshot is None:
        return new.select("n.*")
    open_ = snapshot.where(F.col(VALID_TO).isNull()).select(F.col(key).alias("__key"), F.struct(*opened.columns).alias("s"))
    pair = open_.join(new, F.col("__key") == F.col(key), "full_outer")
    both = F.col("s").isNotNull() & F.col("n").isNotNull()
    change = F.coalesce(both & changed(lambda c: F.col(f"s.{c}"), lambda c: F.col(f"n.{c}")), F.lit(False))
    old = F.when(change, F.col("s").withField(VALID_TO, F.col(f"n.{VALID_FROM}"))).otherwise(F.col("s"))
    rows = F.filter(F.array(old, F.when(change | F.col("s").isNull(), F.col("n"))), lambda r: r.isNotNull())
    return snapshot.where(F.col(VALID_TO).isNotNull()).select(*opened.columns).unionByName(pair.select(F.inline(rows)))


def snapshot_check(snapshot: DataFrame | None, run: DataFrame, key: str, check_cols: Sequence[str],
                   run_ts: str) -> DataFrame:
    """Check strategy: a new version when any of ``check_cols`` changes."""
    return _apply(snapshot, run, key, F.lit(run_ts).cast("timestamp"),
                  lambda old, new: ~F.struct(*map(old, check_cols)).eqNullSafe(F.struct(*map(new, check_cols))))


def snapshot_timestamp(snapshot: DataFrame | None, run: DataFrame, key: str, updated_at: str = "updated_at") -> DataFrame:
    """Timestamp strategy: a new version when ``updated_at`` is newer than the
    open version's; the version starts at ``updated_at``."""
    return _apply(snapshot, run, key, F.col(updated_at).cast("timestamp"), lambda old, new: new(UPDATED) > old(UPDATED))


def history_from_changes(obs: DataFrame, key: str, order: Sequence[str], tracked: Sequence[str],
                         start_col: str = "valid_from", end_col: str = "valid_to",
                         heavy: dict[int, int] | None = None) -> DataFrame:
    """One-pass type-2 history from repeated observations of ``key``.

    ``order`` must be total within a key (e.g. ts, id); the start of a
    version is the first column of ``order``.  The windows before and after the
    filter share one exchange and one sort on (key, order); a key holding a
    third of all observations is cut into slices (``operators.skew``)."""
    now = F.struct(*tracked)
    seen = Sliced.of(obs, [key], order, heavy).before(now, "__prev")
    kept = seen.where(F.col("__prev").isNull() | ~F.col("__prev.v").eqNullSafe(now))
    kept = kept.after(F.col(order[0]), "__next").number("__no")
    return kept.select(*obs.columns, F.col(order[0]).alias(start_col), F.col("__next.v").alias(end_col),
                       F.col("__no").alias("version_no"), F.col("__next.v").isNull().alias("is_current"))


def dimension_view(snapshot: DataFrame, key: str, surrogate: str, columns: Sequence[str]) -> DataFrame:
    """Dimension rows from a snapshot: ``surrogate`` = md5(key|valid_from text),
    first version valid from 1900-01-01, open end 9999-12-31, current flag."""
    v = Sliced.of(snapshot, [key], [VALID_FROM]).number("_version_no").df
    return v.select(
        md5_key(F.col(key).cast("string"), F.col(VALID_FROM).cast("string")).alias(surrogate),
        *columns,
        F.when(F.col("_version_no") == 1, F.lit(OPEN_START).cast("timestamp")).otherwise(F.col(VALID_FROM)).alias(
            "valid_from"),
        F.coalesce(F.col(VALID_TO), F.lit(OPEN_END).cast("timestamp")).alias("valid_to"),
        F.col(VALID_TO).isNull().alias("is_current"),
    )
