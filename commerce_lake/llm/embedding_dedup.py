"""Embedding near-duplicates through a pivot-permutation index.

A vector is described by its ``k`` nearest reference points in order of
nearness.  Inverted lists, one per label and pivot, hold the vectors that name
the pivot; two vectors of one list are candidates when they share at least
``shared`` of their k pivots, and a candidate pair is linked when its cosine
(double precision) reaches the threshold.  A pair that meets in several lists
is counted in the list of its smallest common pivot alone.

Reference points come from a bounded sample (``pivot_count``: four times the
square root of the number of distinct vectors, at most ``MAX_PIVOTS``), thinned
so that no two lie close together (a large group of near copies would otherwise
fill the sample).  Every vector is indexed.  A list longer than ``BLOCK`` is cut
into blocks by a hash; each pair of blocks is a group of its own, so a list of
any length is processed in bounded memory and no pair is lost.  Equal vectors
of a label are one class before any of this.

More pivots make two near vectors name fewer of the same, so ``k`` grows with
them (``nearest_count``).

Defined cases: a vector that is null, zero-length, zero or holds null or
non-finite components, or has no label, links with nothing; vectors of another
length than most (the sample's commonest) are compared only with the same
length; equal vectors link; a null vec_id counts as a linked vector and never
names a component unless all are null; repeated rows are copies; empty tables
give no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .scratch import Scratch

COSINE = 0.93
NEAREST, MOST, SHARED = 8, 16, 2
MAX_PIVOTS, THIN = 8192, 0.8
BLOCK = 2048


def pivot_count(n: int) -> int:
    return min(MAX_PIVOTS, max(16, math.ceil(4 * math.sqrt(n))))


def nearest_count(pivots: int) -> int:
    """k for a number of pivots: 8 up to 64, 12 at 180, 16 from 513 on."""
    return min(MOST, max(NEAREST, 2 * math.ceil(math.log2(max(1, pivots))) - 4))


def _unit(col: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    x = np.asarray(col.flatten(), dtype=np.float64).reshape(-1, dim)
    return x / np.sqrt((x * x).sum(1))[:, None]


def choose_pivots(vectors: list, thin: float = THIN) -> np.ndarray:
    """Unit reference points: the sample's rows in order, without those within cosine ``thin`` of an earlier one."""
    x = np.array(vectors, dtype=np.float64)
    x /= np.sqrt((x * x).sum(1))[:, None]
    kept = np.empty_like(x)
    n = 0
    for row in x:
        if n == 0 or (kept[:n] @ row).max() < thin:
            kept[n] = row
            n += 1
    return kept[:n].astype(np.float32)


def _describe(classes: DataFrame, pivots: np.ndarray, k: int) -> DataFrame:
    """cid, label, n, embedding and perm: the k nearest pivots in order (ties by pivot number)."""
    held = classes.sparkSession.sparkContext.broadcast(pivots)
    dim = pivots.shape[1]

    def run(batches):
        p = held.value
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                sim = _unit(part.column(3), dim).astype(np.float32) @ p.T
                m = min(k, sim.shape[1])
                near = np.argpartition(-sim, m - 1, axis=1)[:, :m]
                near = np.take_along_axis(near, np.lexsort((near, -np.take_along_axis(sim, near, 1)), axis=1), 1)
                perm = pa.ListArray.from_arrays(pa.array(np.arange(len(near) + 1) * m, pa.int32()),
                                                pa.array(near.ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, perm], ["cid", "label", "n", "embedding", "perm"])

    return (classes.select("cid", "label", "n", "embedding")
            .mapInArrow(run, "cid long, label int, n long, embedding array<float>, perm array<int>"))


def _pairs(cid, n, part, perm, x, pivot, crossed, cosine, shared):
    """Linked pairs of one group whose smallest common pivot is ``pivot``."""
    named = np.zeros((len(cid), perm.max() + 1), dtype=np.float32)
    named[np.arange(len(cid))[:, None], perm] = 1
    named = named[:, np.unique(perm)]
    below = np.searchsorted(np.unique(perm), pivot)
    met = (named @ named.T >= shared) & (named[:, :below] @ named[:, :below].T == 0)
    if crossed:  # two blocks of a long list: pairs between them only
        met &= part[:, None] != part[None, :]
    a, b = np.nonzero(np.triu(met, 1))
    if not len(a):
        return None
    out = []
    for at in range(0, len(a), 1 << 16):
        i, j = a[at:at + (1 << 16)], b[at:at + (1 << 16)]
        out.append(np.einsum("ij,ij->i", x[i], x[j]) >= cosine)
    ok = np.concatenate(out)
    a, b = a[ok], b[ok]
    return cid[a], cid[b], n[a], n[b]


def _links_of_lists(lists: DataFrame, dim: int, cosine: float, shared: int) -> DataFrame:
    """Linked class pairs (a, b, na, nb); ``lists`` is partitioned and sorted by label, pivot, i, j."""
    names = ["a", "b", "na", "nb"]

    def group(keys, cols):
        cid, n, part, perm, emb = cols
        if len(cid) < 2:
            return None
        return _pairs(cid, n, part, perm, emb, keys[1], keys[2] != keys[3], cosine, shared)

    def run(batches):
        key, held = None, []
        for b in batches:
            k = np.stack([np.asarray(b.column(i), dtype=np.int64) for i in range(4)], axis=1)
            m = len(b.column(7)[0]) if b.num_rows else 0
            cols = (np.asarray(b.column(4)), np.asarray(b.column(5)), np.asarray(b.column(6)),
                    np.asarray(b.column(7).flatten()).reshape(-1, m) if m else None,
                    _unit(b.column(8), dim) if b.num_rows else None)
            if not b.num_rows:
                continue
            cuts = np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1
            for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(k)]):
                mine = tuple(k[lo].tolist())
                if mine != key and held:
                    if (r := group(key, [np.concatenate(c) for c in zip(*held)])) is not None:
                        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in r], names)
                    held = []
                key = mine
                held.append([c[lo:hi] for c in cols])
        if held and (r := group(key, [np.concatenate(c) for c in zip(*held)])) is not None:
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in r], names)

    return lists.mapInArrow(run, "a long, b long, na long, nb long")


def _posted(described: DataFrame, block: int) -> DataFrame:
    """One row per list entry; an entry of a long list once per pair of blocks that it takes part in."""
    entries = described.withColumn("pivot", F.explode("perm"))
    long_lists = (described.select("label", F.explode("perm").alias("pivot")).groupBy("label", "pivot")
                  .agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > block)
                  .select("label", "pivot", F.ceil(F.col("size") / block).cast("int").alias("blocks")))
    mine = F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    return (entries.join(long_lists, ["label", "pivot"], "left").withColumn("part", mine)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks"), F.lit(1)) - 1)))
            .select("label", "pivot", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
                    "cid", "n", "part", "perm", "embedding"))


def link(vectors: DataFrame, cosine: float = COSINE, k: int | None = None, shared: int = SHARED,
         block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embedding")
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"),
        F.col("embedding").cast("array<float>").alias("embedding")).select(
        "*", F.xxhash64("label", "embedding").alias("k1"), F.hash("label", "embedding").alias("k2"),
        F.coalesce(F.col("label").isNotNull() & F.expr(
            "size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < float('inf'))"
            " and exists(embedding, x -> x <> 0)"), F.lit(False)).alias("valid"))
    classes = scratch.store(
        rows.where("valid").groupBy("k1", "k2")
        .agg(F.first("label").alias("label"), F.first("embedding").alias("embedding"),
             F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    dims = sorted(r.d for r in classes.select(F.size("embedding").alias("d")).distinct().collect())  # few lengths
    found = None
    for dim in dims:
        same = classes.where(F.size("embedding") == dim)
        sample = (same.select("k1", "k2", "embedding").orderBy("k1", "k2").limit(pivot_count(same.count()))
                  .select("embedding").collect())
        pivots = choose_pivots([r.embedding for r in sample])
        described = scratch.store(_describe(same, pivots, k or nearest_count(len(pivots))), "described")
        keys = ["label", "pivot", "i", "j"]
        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
        lists = _posted(described, block).repartition(n, *keys).sortWithinPartitions(*keys)
        some = _links_of_lists(lists, dim, cosine, min(shared, len(pivots)))
        found = some if found is None else found.unionByName(some)
    if found is None:
        found = spark.createDataFrame([], "a long, b long, na long, nb long")
    links = scratch.store(found, "links")
    degree = (links.select(F.col("a").alias("cid"), F.col("nb").alias("m"))
              .unionByName(links.select(F.col("b").alias("cid"), F.col("na").alias("m")))
              .groupBy("cid").agg(F.sum("m").alias("m")))
    component = scratch.store(connected_components(links, scratch), "components")
    named = (classes.select("k1", "k2", "cid", "least", "n").join(degree, "cid", "left")
             .join(component.withColumnRenamed("node", "cid"), "cid", "left")
             .withColumn("component", F.coalesce("component", "cid")))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    result = scratch.store(
        named.join(least, "component").select(
            "k1", "k2", F.lit(True).alias("valid"), "component_id",
            (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("n_links")), "result")
    mine = F.when(F.col("valid"), F.col("component_id")).otherwise(F.col("vec_id"))
    return (rows.select("vec_id", "k1", "k2", "valid").join(result, ["k1", "k2", "valid"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    mine.alias("component_id"), mine.eqNullSafe(F.col("vec_id")).alias("kept")))
