"""Keyed joins and per-key windows that a hot key cannot stall.

AQE splits a skewed partition of a plain sort-merge join only.  It cannot split
one whose other side is an aggregate (master ids, known products, line sums),
nor a window per key.  Here the few heavy keys are found first, by a sketch of
bounded size, and treated apart inside one plan:

* ``attach`` - a many-to-one left join in one pass over the big side.  The
  small side's rows of heavy keys (one per key, so at most ``MOST`` rows) are
  broadcast; in the shuffled join the big side's heavy rows carry a salt that
  matches nothing and deals them out evenly.
* ``Sliced`` - a window per key whose heavy keys are cut into slices of the
  first order column.  The window runs per (key, slice), one exchange and one
  sort for all functions; what a row needs from other slices of its key (the row
  before, the row after, the number of rows before, the last known value) comes
  from one border row a slice, broadcast.  Keys that are not heavy have a
  single slice, so the plan is the plain window's.

Defined cases: null keys never match (joins) or form a key of their own
(windows); without heavy keys both are the plain operators; an empty side gives
nulls; rows that agree in key and first order column stay in one slice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commerce_lake.session import shuffle_partitions

#: Heavy keys tracked, items of the sketch, and slices of a heavy key at most.
MOST, TRACKED, SLICES = 128, 4096, 64
#: A key is heavy when its rows would fill more than this share of a task's even part.
HEAVY = 1.0


def key_hash(keys: Sequence[str | Column]) -> Column:
    return F.xxhash64(*keys)


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float | None = None) -> dict[int, int]:
    """Hash and row count of the keys with more than ``share`` of all rows; a null key counts like any other.

    One aggregation with a frequent-items sketch of fixed size; the counts are
    the sketch's upper bounds, so no heavy key is missed.  The default share is
    ``HEAVY`` even parts of a task.
    """
    hashed = df.select(key_hash(keys).alias("h"))
    row = hashed.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {MOST}, {TRACKED})").alias("top")).first()
    least = row["n"] * (share if share is not None else HEAVY / shuffle_partitions(df.sparkSession))
    return {t["item"]: t["count"] for t in row["top"] or [] if t["count"] > max(least, 1)}


def is_heavy(keys: Sequence[str | Column], heavy: dict[int, int]) -> Column:
    return F.coalesce(key_hash(keys).isin(list(heavy)), F.lit(False)) if heavy else F.lit(False)


def attach(big: DataFrame, small: DataFrame, on: Sequence[str], columns: dict[str, Column | str],
           heavy: dict[int, int] | None = None, spread: Sequence[str] | None = None) -> DataFrame:
    """``big`` with ``columns`` (new name -> expression over ``small``) of the row with the same key.

    ``small`` has one row a key (the caller's promise: an aggregate, a keyed
    table); rows of ``big`` without one get nulls.  ``heavy`` is
    ``heavy_keys(big, on)`` unless given; ``spread`` names the columns whose hash
    deals out a heavy key's rows (all columns by default).
    """
    heavy = heavy_keys(big, on) if heavy is None else heavy
    slim = small.select(*on, *[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()])
    if not heavy:
        return big.join(slim, list(on), "left").select(*big.columns, *columns)
    salt, met = "__salt", "__met"
    # one row a heavy key: at most MOST rows
    hot = slim.where(is_heavy(on, heavy)).select(*on, *[F.col(n).alias(f"__hot_{n}") for n in columns])
    parts = 4 * shuffle_partitions(big.sparkSession)
    deal = F.when(is_heavy(on, heavy), 1 + F.pmod(F.xxhash64(*(spread or big.columns)), F.lit(parts))).otherwise(F.lit(0))
    # always 0, but no literal: a literal would leave the join keys, and the salt deal nothing out
    cold = slim.where(~is_heavy(on, heavy)).withColumn(salt, F.pmod(key_hash(on), F.lit(1)))
    out = (big.withColumn(salt, deal.cast("long")).join(F.broadcast(hot.withColumn(met, F.lit(True))), list(on), "left")
           .join(cold, [*on, salt], "left"))
    return out.select(*big.columns, *[F.when(F.col(met), F.col(f"__hot_{n}")).otherwise(F.col(n)).alias(n) for n in columns])


@dataclass
class Sliced:
    """Windows per key over ``df`` (``keys``, ``order``: ascending columns, nulls first, total within a key).

    ``before`` / ``after`` / ``number`` / ``last_known`` add a column each; all
    windows share one exchange and one sort.
    """

    df: DataFrame
    keys: Sequence[str]
    order: Sequence[str]
    heavy: dict[int, int]
    slice: str = "__slice"

    @classmethod
    def of(cls, df: DataFrame, keys: Sequence[str], order: Sequence[str], heavy: dict[int, int] | None = None) -> "Sliced":
        heavy = heavy_keys(df, keys) if heavy is None else heavy
        if not heavy:
            return cls(df.withColumn("__slice", F.lit(0)), list(keys), list(order), {})
        at = _orderable(df, order[0])
        n = max(2, min(SLICES, 4 * shuffle_partitions(df.sparkSession)))
        cuts = [i / n for i in range(1, n)]
        bounds = {r["h"]: sorted(set(r["b"])) for r in df.where(is_heavy(keys, heavy)).groupBy(key_hash(keys).alias("h"))
                  .agg(F.percentile_approx(at, cuts, 1000).alias("b")).collect() if r["b"]}  # a row a heavy key
        if not bounds:
            return cls(df.withColumn("__slice", F.lit(0)), list(keys), list(order), {})
        lists = F.create_map(*[x for h, b in bounds.items() for x in (F.lit(h), F.array(*map(F.lit, b)))])
        mine = F.size(F.filter(F.element_at(lists, key_hash(keys)), lambda b: b <= at))
        return cls(df.withColumn("__slice", F.when(is_heavy(keys, heavy) & at.isNotNull(), mine).otherwise(F.lit(0))),
                   list(keys), list(order), heavy)

    def _window(self):
        return Window.partitionBy(*self.keys, self.slice).orderBy(*[F.col(c).asc() for c in self.order])

    def _borders(self, **aggregates: Column) -> DataFrame:
        """A row a slice of a heavy key (at most MOST * SLICES), with the aggregates over the slice."""
        return self.df.where(is_heavy(self.keys, self.heavy)).groupBy(*self.keys, self.slice).agg(
            *[c.alias(n) for n, c in aggregates.items()])

    def _joined(self, borders: DataFrame, names: Sequence[str]) -> DataFrame:
        on = [*self.keys, self.slice]
        slim = borders.select(*on, *names)
        for k in on:
            slim = slim.withColumnRenamed(k, f"__b_{k}")
        same = [F.col(k).eqNullSafe(F.col(f"__b_{k}")) for k in on]
        cond = same[0]
        for c in same[1:]:
            cond = cond & c
        return self.df.join(F.broadcast(slim), cond, "left").drop(*[f"__b_{k}" for k in on])

    def _with(self, df: DataFrame) -> "Sliced":
        return Sliced(df, self.keys, self.order, self.heavy, self.slice)

    def where(self, condition: Column | str) -> "Sliced":
        return self._with(self.df.where(condition))

    def select(self, *columns) -> DataFrame:
        return self.df.select(*columns)

    def _neighbour(self, value: Column, out: str, ahead: bool) -> "Sliced":
        """``out``: struct ``v`` of the neighbouring row's value, null at the key's end."""
        w = self._window()
        held = F.struct(value.alias("v"))
        near = (F.lead if ahead else F.lag)(held).over(w)
        if not self.heavy:
            return self._with(self.df.withColumn(out, near))
        order = F.struct(*self.order)
        edge = self._borders(__edge=(F.min_by if ahead else F.max_by)(held, order))
        by = Window.partitionBy(*self.keys).orderBy(F.col(self.slice).desc() if ahead else F.col(self.slice).asc())
        edge = edge.withColumn("__far", F.lag("__edge").over(by))
        return self._with(self._with(self.df.withColumn(out, near))._joined(edge, ["__far"])
                          .withColumn(out, F.coalesce(F.col(out), F.col("__far"))).drop("__far"))

    def before(self, value: Column, out: str) -> "Sliced":
        return self._neighbour(value, out, False)

    def after(self, value: Column, out: str) -> "Sliced":
        return self._neighbour(value, out, True)

    def number(self, out: str) -> "Sliced":
        """1-based row number within the key."""
        mine = F.row_number().over(self._window()).cast("long")
        if not self.heavy:
            return self._with(self.df.withColumn(out, mine))
        counts = self._borders(__n=F.count(F.lit(1)))
        by = Window.partitionBy(*self.keys).orderBy(self.slice).rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("__off", F.coalesce(F.sum("__n").over(by), F.lit(0)))
        return self._with(self._with(self.df.withColumn(out, mine))._joined(counts, ["__off"])
                          .withColumn(out, F.col(out) + F.coalesce("__off", F.lit(0))).drop("__off"))

    def last_known(self, value: Column, out: str) -> "Sliced":
        """The last value that is not null, up to and with the row."""
        w = self._window().rowsBetween(Window.unboundedPreceding, 0)
        near = F.last(value, ignorenulls=True).over(w)
        if not self.heavy:
            return self._with(self.df.withColumn(out, near))
        edge = self._borders(__edge=F.max_by(value, F.when(value.isNotNull(), F.struct(*self.order))))
        by = Window.partitionBy(*self.keys).orderBy(self.slice).rowsBetween(Window.unboundedPreceding, -1)
        edge = edge.withColumn("__far", F.last("__edge", ignorenulls=True).over(by))
        return self._with(self._with(self.df.withColumn(out, near))._joined(edge, ["__far"])
                          .withColumn(out, F.coalesce(F.col(out), F.col("__far"))).drop("__far"))


def _orderable(df: DataFrame, column: str) -> Column:
    """The column as a number that keeps its order, for cutting slices."""
    kind = dict(df.dtypes)[column]
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if kind == "date":
        return F.datediff(F.col(column), F.lit("1970-01-01").cast("date")).cast("long")
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.col(column).cast("long")
    raise TypeError(f"slices are cut by a time or a whole number, got {kind}")
