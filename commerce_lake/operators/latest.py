"""Top-1 per key (latest version, selected payment).

``row_number() = 1`` over a window partitioned by the key.  Spark 4 plans this
as a partial WindowGroupLimit *before* the shuffle and a final one after it,
so every map task already keeps one row per key: a key holding a third of
all rows reaches the exchange as one row per map task, not as a third of the
data.  Ties are broken by a hash of the whole row so the result does not
depend on task order.

The partial limit sorts the rows of a whole input split in one task, so its
memory grows with the split.  A caller that knows of no heavy key says
``partial=False``: rows are sorted after the shuffle only, by partitions that
AQE sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols: Sequence[Column | str]) -> list[Column]:
    out = []
    for c in cols:
        out.append(F.col(c).desc_nulls_last() if isinstance(c, str) else c)
    return out


def row_tiebreak(df: DataFrame) -> Column:
    """Deterministic last-resort order: 64-bit hash of every column."""
    return F.xxhash64(*[F.col(c) for c in df.columns])


def top1_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], tiebreak: bool = True,
            partial: bool = True) -> DataFrame:
    """One row per ``keys``: the first in ``order`` (strings mean DESC NULLS LAST).

    ``partial``: each map task keeps one row per key first (for keys that may be heavy)."""
    ordering = _order(order)
    if tiebreak:
        ordering.append(row_tiebreak(df).desc())
    w = Window.partitionBy(*keys).orderBy(*ordering)
    if not partial:  # the row that none precedes; Spark infers no partial limit from it
        return df.withColumn("_before", F.lag(F.lit(True)).over(w)).where(F.col("_before").isNull()).drop("_before")
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def latest_by(df: DataFrame, key: str | Sequence[str], order_col: str, ingested_col: str = "_ingested_at",
              partial: bool = True) -> DataFrame:
    """Newest version per key: ``order_col`` desc, then ingestion time desc,
    then the row hash.  ``order_col`` is compared on its typed value (a text
    timestamp is parsed first), never as text."""
    keys = [key] if isinstance(key, str) else list(key)
    dtype = dict(df.dtypes)[order_col]
    o = F.col(order_col)
    if dtype == "string":
        o = F.expr(f"try_cast(`{order_col}` AS timestamp)")
    order: list[Column] = [o.desc_nulls_last()]
    if ingested_col in df.columns:
        order.append(F.col(ingested_col).desc_nulls_last())
    return top1_by(df, keys, order, partial=partial)
