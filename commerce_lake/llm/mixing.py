"""Mixing sources to target weights by entropy balancing.

``targets`` shares the corpus's size among its sources by weight; no target
exceeds ``LIMIT`` times its source's size, and the excess is shared again.
``rates`` finds, per source, the document rates closest in relative entropy to
one that meet the source's token constraint: rate = exp(lambda * x), cut at
LIMIT, with x the document's size over the source's mean size (weighted by
size).  lambda is the root of the convex dual's gradient, found by Newton steps
inside a shrinking bracket; every step is one distributed aggregation over
slim rows, for all sources at once.  ``mix`` rounds the rates into copies: a
dithered rounding first, then the dither of a source is shifted (a distributed
search, 256 thresholds a pass) until the whole copies meet the target; the
documents on the final threshold, usually one, take the rest as part of a copy.

All sums run over integers or decimals, so that reruns and lost executors give
equal results whatever the order.

Defined cases: a null or blank text has size 0 and takes nothing; a null source
is a source, the last one; a source of size 0 has target 0; equal rows of one
doc_id share a dither and are treated alike; a null doc_id is hashed as such;
empty tables give no rows; further columns are ignored by ``mix`` and repeated
by ``copies``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .names import free_prefix
from .scratch import Scratch

WEIGHTS, LIMIT = (1, 2, 3), 3
NEWTON_STEPS, TOLERANCE = 60, 1e-9
BINS, PASSES = 256, 5
BLANK = " \t\n\x0b\f\r"


def n_words(text: Column) -> Column:
    """Number of runs of other than the six ASCII white-space characters."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK))
    return F.when(inner == "", 0).otherwise(F.size(F.split(inner, r"[\x20\x09-\x0D]+"))).cast("long")


def _exact(x: Column) -> Column:
    """A term of a sum that no order of addition changes."""
    return x.cast("decimal(30,6)")


def source_totals(sized: DataFrame) -> DataFrame:
    """source, source_size and mean_size (weighted by size) of every source."""
    return (sized.groupBy("source")
            .agg(F.sum("size").alias("source_size"),
                 F.sum(F.col("size").cast("decimal(20,0)") * F.col("size")).alias("squares"))
            .select("source", "source_size",
                    F.greatest(F.coalesce(F.try_divide(F.col("squares").cast("double"), F.col("source_size")), F.lit(1.0)),
                               F.lit(1.0)).alias("mean_size")))


def targets(totals: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """``totals`` with the target of every source.

    Weights repeat over the sources by code point, nulls last.  Sources are
    ranked by range partitions (position within the partition plus the rows of
    the partitions before), so that millions of sources do not meet in one task.
    """
    ranged = (totals.repartitionByRange(F.col("source").asc_nulls_last())
              .sortWithinPartitions(F.col("source").asc_nulls_last())
              .withColumn("at", F.monotonically_increasing_id()))
    ranged = scratch.store(ranged.withColumn("part", F.shiftright("at", 33))
                           .withColumn("at", F.col("at").bitwiseAND(F.lit((1 << 33) - 1))), "ranged")
    # one row per range partition, so the ordered sum is bounded by their number
    before = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("c")).select(
        "part", F.coalesce(F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)).alias("before"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("before") + F.col("at"), F.lit(len(weights))) + 1).cast("int"))
    weighted = scratch.store(ranged.join(before, "part").select(
        "source", "source_size", "mean_size", weight.cast("long").alias("weight")), "weighted")
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    # the level: target = min(limit * size, level * weight), with the targets adding up to the total
    full = F.lit(False)
    level, at_limit = 0.0, -1
    while True:
        r = weighted.agg(F.sum(F.when(full, F.col("source_size") * limit)).alias("taken"),
                         F.sum(F.when(~full, F.col("weight"))).alias("w"),
                         F.count_if(full).alias("n")).first()
        if r.n == at_limit or not r.w:
            break
        at_limit, level = r.n, (total - (r.taken or 0)) / r.w
        full = F.col("source_size") * limit <= F.lit(level) * F.col("weight")
    return weighted.withColumn("target", F.when(full, F.col("source_size") * F.lit(float(limit)))
                               .otherwise(F.lit(level) * F.col("weight")).cast("double"))


def _key(source: Column) -> Column:
    """Join key of a source that tells null from any text."""
    return F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source.cast("string")))


def _rate(state: str = "") -> Column:
    tilt = F.exp(F.col(f"{state}lam") * F.col(f"{state}size") / F.col(f"{state}mean_size"))
    return F.least(tilt, F.lit(float(LIMIT)))


def rates(slim: DataFrame, goals: DataFrame, scratch: Scratch) -> DataFrame:
    """``goals`` (a row a source) with lam, the multiplier that meets the source's token constraint.

    Newton steps on the logarithm of the taken words, which is convex while no
    document is at the limit; a step that leaves the bracket halves it instead.
    """
    # the bracket: at hi a one-word document is at the limit, at lo it has rate e**-700
    state = scratch.store(
        goals.withColumn("lo", -700.0 * F.col("mean_size"))
        .withColumn("hi", F.lit(1.1 * math.log(LIMIT)) * F.col("mean_size"))
        .withColumn("lam", F.lit(0.0)).withColumn("done", F.col("target") <= 0), "state")
    for _ in range(NEWTON_STEPS):
        rate = _rate()
        slope = F.when(rate < LIMIT, F.col("size") * rate * F.col("size") / F.col("mean_size")).otherwise(0.0)
        sums = (slim.join(state.where("not done").select("key", "lam", "mean_size"), "key")
                .groupBy("key").agg(F.sum(_exact(F.col("size") * rate)).cast("double").alias("f"),
                                    F.sum(_exact(slope)).cast("double").alias("df")))
        miss = F.col("f") - F.col("target")
        lo = F.when(miss < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(miss > 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.when((F.col("df") > 0) & (F.col("f") > 0),
                        F.col("lam") - F.log(F.col("f") / F.col("target")) * F.col("f") / F.col("df"))
        nxt = F.when((newton > lo) & (newton < hi), newton).otherwise((lo + hi) / 2)
        met = (F.abs(miss) <= TOLERANCE * F.col("target")) | ((hi - lo) <= 1e-12 * F.abs(hi))
        done = F.col("done") | F.coalesce(met, F.lit(True))
        old = state
        state = scratch.store(
            state.join(sums, "key", "left").select(
                *goals.columns, F.when(done, F.col("lo")).otherwise(lo).alias("lo"),
                F.when(done, F.col("hi")).otherwise(hi).alias("hi"),
                F.when(done, F.col("lam")).otherwise(nxt).alias("lam"), done.alias("done")), "state")
        scratch.drop(old)
        if not state.where("not done").take(1):
            break
    return state.select(*goals.columns, "lam")


def _dither(doc_id: Column) -> Column:
    """Uniform in [0, 1), a function of the id."""
    return F.shiftrightunsigned(F.xxhash64(doc_id), 11).cast("double") / float(1 << 53)


def _thresholds(slim: DataFrame, state: DataFrame, scratch: Scratch) -> DataFrame:
    """``state`` with the rounding of each source: a document of rate r and dither u takes its k-th
    copy if k - r - u < lo, and the share ``part`` of one if that lies in [lo, hi)."""
    events = F.array(*[F.lit(float(k)) for k in range(1, LIMIT + 1)])
    state = scratch.store(state.withColumn("lo", F.lit(-float(LIMIT + 1))).withColumn("hi", F.lit(float(LIMIT + 1)))
                          .withColumn("below", F.lit(0).cast("long")).withColumn("inside", F.lit(0).cast("long")), "state")
    for _ in range(PASSES):
        width = (F.col("hi") - F.col("lo")) / BINS
        at = (slim.join(state.select("key", "lam", "mean_size", "lo", "hi"), "key")
              .withColumn("k", F.explode(events)).withColumn("e", F.col("k") - _rate() - F.col("u"))
              .where((F.col("e") >= F.col("lo")) & (F.col("e") < F.col("hi")))
              .groupBy("key", F.least(F.floor((F.col("e") - F.col("lo")) / width), F.lit(BINS - 1)).alias("bin"))
              .agg(F.sum("size").alias("words")))
        so_far = Window.partitionBy("key").orderBy("bin")  # at most BINS rows a source
        crossed = (at.withColumn("upto", F.sum("words").over(so_far))
                   .join(state.select("key", "below", "target"), "key")
                   .where(F.col("below") + F.col("upto") >= F.col("target"))
                   .groupBy("key").agg(F.min_by(F.struct("bin", "words", (F.col("upto") - F.col("words")).alias("before")),
                                                "bin").alias("c")))
        kept = [c for c in state.columns if c not in ("lo", "hi", "below", "inside")]
        low = F.col("lo") + F.col("c.bin") * width
        old = state
        state = scratch.store(state.join(crossed, "key", "left").select(
            *kept, F.coalesce(low, "lo").alias("lo"),
            F.coalesce(F.when(F.col("c.bin") == BINS - 1, F.col("hi")).otherwise(F.col("lo") + (F.col("c.bin") + 1) * width), "hi").alias("hi"),
            (F.col("below") + F.coalesce("c.before", F.lit(0))).alias("below"),
            F.coalesce("c.words", "inside").alias("inside")), "state")
        scratch.drop(old)
    part = F.when(F.col("inside") > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("target") - F.col("below")) / F.col("inside"))))
    return state.withColumn("part", F.coalesce(part, F.lit(0.0))).drop("below", "inside")


def plan(docs: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS) -> tuple[DataFrame, DataFrame]:
    """The slim rows (key, doc_id, size, u) and the per-source state that decides all copies."""
    slim = scratch.store(docs.select(_key(F.col("source")).alias("key"), F.col("source").cast("string").alias("source"),
                                     "doc_id", n_words(F.col("text")).alias("size"), _dither(F.col("doc_id")).alias("u")), "slim")
    totals = scratch.store(source_totals(slim), "totals")
    goals = targets(totals, scratch, weights)
    goals = scratch.store(goals.select(_key(F.col("source")).alias("key"), "source_size", "mean_size", "target"), "goals")
    slim = slim.select("key", "doc_id", "size", "u")
    return slim, scratch.store(_thresholds(slim, rates(slim, goals, scratch), scratch), "plan")


def _taken(p: str) -> tuple[Column, Column]:
    """Whole copies, and words of one more part of a copy."""
    shifted = _rate(p) + F.col(f"{p}u")
    # events before lo: k < lo + r + u, for k in 1..LIMIT
    whole = F.greatest(F.lit(0), F.least(F.lit(LIMIT), F.ceil(F.col(f"{p}lo") + shifted) - 1))
    upto_hi = F.greatest(F.lit(0), F.least(F.lit(LIMIT), F.ceil(F.col(f"{p}hi") + shifted) - 1))
    whole = F.when(F.col(f"{p}size") > 0, whole).otherwise(0)  # an empty document takes nothing
    words = F.round(F.col(f"{p}size") * F.col(f"{p}part") * (upto_hi - whole)).cast("long")
    return whole.cast("long"), F.least(words, F.col(f"{p}size") * (F.lit(LIMIT) - whole))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """doc_id, size, source_size, target, rate, copies (whole), part_words and taken of every row."""
    scratch = Scratch(docs.sparkSession, "mixing")
    slim, state = plan(docs, scratch, weights)
    whole, words = _taken("")
    return (slim.join(state, "key").select(
        "doc_id", "size", "source_size", "target", _rate().alias("rate"), whole.alias("copies"),
        words.alias("part_words"), (whole * F.col("size") + words).alias("taken")))


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The rows of the mix with all their columns: each document as often as it is taken whole.

    A part of a copy of at least half a document becomes a copy, a smaller one
    none.  Sources are few beside documents, so the text is not shuffled unless
    the state outgrows a broadcast.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    _, state = plan(docs, scratch, weights)
    p = free_prefix(docs, "__mix_")
    state = state.select(*[F.col(c).alias(p + c) for c in state.columns])
    state = F.broadcast(state) if state.count() <= 100_000 else state
    whole, words = _taken(p)
    times = whole + F.when((words > 0) & (words * 2 >= F.col(p + "size")), 1).otherwise(0)
    out = (docs.withColumn(p + "key", _key(F.col("source"))).withColumn(p + "size", n_words(F.col("text")))
           .withColumn(p + "u", _dither(F.col("doc_id"))).join(state, p + "key")
           .withColumn(p + "n", times).where(F.col(p + "n") > 0)
           .withColumn(p + "i", F.explode(F.sequence(F.lit(1).cast("long"), F.col(p + "n")))))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
