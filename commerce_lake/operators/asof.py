"""As-of join: the dimension version valid at the fact's time.

``asof_join`` is an equi-join on the business key with the half-open interval
(``valid_from <= t < valid_to``) as a residual condition: right for keys of few
versions, whatever overlaps.

``asof_ordered`` puts facts and versions of a key in one time order and carries
the last version forward: each fact meets one version however many its key has,
and a heavy key is cut into slices that hand their last version on
(``operators.skew``), so it is neither multiplied nor gathered.  It expects
versions of a key that don't overlap (``assert_no_overlap``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake.operators.skew import Sliced


def asof_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, fact_time: str,
              how: str = "left", valid_from: str = "valid_from", valid_to: str = "valid_to",
              prefix: str = "d_") -> DataFrame:
    """Join each fact row to the ``dim`` version whose interval holds
    ``fact_time``.  Dimension columns other than the key get ``prefix``."""
    d = dim.select(
        *[F.col(c).alias(f"{prefix}{c}") for c in dim.columns]
    )
    cond = (
        (fact[fact_key] == d[f"{prefix}{dim_key}"])
        & (fact[fact_time] >= d[f"{prefix}{valid_from}"])
        & (fact[fact_time] < d[f"{prefix}{valid_to}"])
    )
    return fact.join(d, cond, how)


def asof_ordered(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, fact_time: str,
                 how: str = "left", valid_from: str = "valid_from", valid_to: str = "valid_to",
                 prefix: str = "d_", heavy: dict[int, int] | None = None, take: Sequence[str] | None = None) -> DataFrame:
    """The rows and columns of ``asof_join`` (of ``dim`` only ``take``, if given), by one ordered pass per key.

    A fact exactly at ``valid_from`` belongs to that version, one at
    ``valid_to`` to the next; a null key or time meets no version; an open end
    is a far date or null.  ``how`` is left or inner."""
    kind = dict(fact.dtypes)[fact_key]
    take = list(dim.columns if take is None else take)
    # the key and a timestamp travel once, not in the struct again
    once = {fact_key: "__k"} | ({fact_time: "__t"} if dict(fact.dtypes)[fact_time] == "timestamp" else {})
    rest = [c for c in fact.columns if c not in once]
    facts = fact.select(F.col(fact_key).alias("__k"), F.col(fact_time).cast("timestamp").alias("__t"), F.lit(1).alias("__o"),
                        F.struct(F.lit(True).alias("__is"), *rest).alias("__f"), F.lit(None).alias("__v"))
    versions = dim.where(F.col(dim_key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(dim_key).cast(kind).alias("__k"), F.col(valid_from).cast("timestamp").alias("__t"), F.lit(0).alias("__o"),
        F.lit(None).alias("__f"), F.struct(*dict.fromkeys([*take, valid_to])).alias("__v"))
    s = Sliced.of(facts.unionByName(versions), ["__k"], ["__t", "__o"], heavy).last_known(F.col("__v"), "__now")
    end = F.col(f"__now.{valid_to}")
    holds = F.col("__k").isNotNull() & F.col("__t").isNotNull() & (end.isNull() | (F.col("__t") < end))
    rows = s.df.where(F.col("__f").isNotNull()).withColumn("__now", F.when(holds, F.col("__now")))
    if how == "inner":
        rows = rows.where(F.col("__now").isNotNull())
    elif how != "left":
        raise ValueError(f"left or inner, got {how}")
    return rows.select(*[F.col(once.get(c, f"__f.{c}")).alias(c) for c in fact.columns],
                       *[F.col(f"__now.{c}").alias(f"{prefix}{c}") for c in take])


def assert_no_overlap(dim: DataFrame, key: str, valid_from: str = "valid_from", valid_to: str = "valid_to") -> int:
    """Number of versions that start before the previous version of the same
    key ends (0 for a well-formed type-2 dimension)."""
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy(valid_from)
    prev_end = F.lag(valid_to).over(w)
    return dim.withColumn("_pe", prev_end).where(F.col("_pe") > F.col(valid_from)).count()
