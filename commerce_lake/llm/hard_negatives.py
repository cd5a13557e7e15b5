"""Hard negatives through an inverted multi-index.

Vectors are integers (``floor(256 * x)``), scores integer inner products.  The
rows are dealt to shards by a hash of their id; every shard cuts its vectors in
two halves and quantises each half with its own codebook (``codebooks``: k-means
on a bounded sample, the same for all shards), so a pair of codes is a cell with
an inverted list.  For an anchor the half score of a code is at most
``q . c + |q| * radius`` with the radius of the code's vectors in this shard,
and a cell's score at most the sum of its two half bounds.  A heap over the two
codebooks, each sorted by bound (the multi-sequence algorithm), yields the cells
in falling order of that sum.  The anchor scores the lists as they come and
stops once its answers are certified: every wanted place is filled with a score
above the next bound, or the next bound is below the lowest score wanted.  So
the answers of a shard are exact, and so are the merged ones.

Two passes: the first finds the positives (an index per label), the second the
first negatives inside each positive's score window (one index over all rows).
In each, a task holds one shard's index and streams the anchors past it; the
answers of all shards, a few rows an anchor, are merged by a window per anchor
or per pair.  Anchors are a stated query set (every ``every``-th id), met by
every shard; nothing is broadcast but the codebooks.

Bounds are double precision with a margin far above rounding, scores exact: a
matrix product of doubles where all sums stay below 2^53, whole numbers of any
size otherwise (a score beyond a long raises).

Defined cases: a row with a null label, a null vector, a null or non-finite
component or a null id takes no part; equal rows (id, label and vector) count
once; an anchor's other rows have another id; vectors of another length than the
anchor's are not compared; an anchor without positives has no rows, a pair
without negatives none; ties are broken by the smaller id; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

EVERY, POSITIVES, NEGATIVES = 50, 5, 3
LOW, HIGH = 50, 95  # percent of the positive's score
SCALE = 256
SHARD_ROWS, LEAST_SHARD_ROWS = 50_000, 2_000
SAMPLE, MAX_CODES, ROUNDS = 20_000, 64, 8
LIST_ROWS = 64  # rows a cell that the number of codes aims at
BLOCK_ROWS = 1024  # rows that are scored at once
EXACT = float(1 << 53)


def whole_numbers(vectors: DataFrame, label: Column) -> DataFrame:
    """vec_id, label and the whole-number vector of the rows that take part."""
    e = F.col("embedding").cast("array<double>")
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), e.alias("e"))
            .where("vec_id is not null and label is not null and e is not null and "
                   "forall(e, x -> x is not null and not isnan(x) and abs(x) < double('inf'))")
            # beyond 2^52 a double is whole already
            .select("vec_id", "label", F.transform("e", lambda x: F.when(F.abs(SCALE * x) < 2.0 ** 52, F.floor(SCALE * x).cast("double"))
                                                   .otherwise(SCALE * x)).alias("v")))


def codebooks(sample: np.ndarray, codes: int) -> tuple[np.ndarray, np.ndarray]:
    """One codebook a half: k-means from evenly spaced rows of the sample, a fixed number of rounds."""
    half = sample.shape[1] // 2
    out = []
    for x in (sample[:, :half], sample[:, half:]):
        x = np.unique(x, axis=0) if x.shape[1] else x[:1]
        c = x[np.linspace(0, len(x) - 1, min(codes, len(x))).astype(int)].copy()
        for _ in range(ROUNDS):
            near = nearest(x, c)
            n = np.bincount(near, minlength=len(c))
            sums = np.zeros_like(c)
            np.add.at(sums, near, x)
            c[n > 0] = sums[n > 0] / n[n > 0, None]
        out.append(c)
    return out[0], out[1]


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    if not x.shape[1]:
        return np.zeros(len(x), dtype=np.int64)
    return (x @ (-2 * c.T) + (c * c).sum(1)).argmin(1)


def scores_of(x: np.ndarray, size: np.ndarray, q: np.ndarray, q_size: float) -> np.ndarray:
    """Exact inner products; ``size``: Euclidean norms, which bound all partial sums of products."""
    if not len(x) or size.max() * q_size < EXACT:
        return (x @ q).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(row, q)) for row in x]
    if any(abs(v) >= 1 << 63 for v in exact):
        raise OverflowError("a score is beyond a long")
    return np.array(exact, dtype=np.int64)


class Index:
    """Inverted lists by pairs of half codes over the rows of one shard."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, books: tuple[np.ndarray, np.ndarray]):
        half = x.shape[1] // 2
        parts = (x[:, :half], x[:, half:])
        codes = [nearest(p, c) for p, c in zip(parts, books)]
        #: radius of each code's vectors here; -inf: no vector of this shard has it
        self.books, self.half, self.radius = books, half, []
        for p, c, k in zip(parts, books, codes):
            r = np.full(len(c), -np.inf)
            np.maximum.at(r, k, np.sqrt(((p - c[k]) ** 2).sum(1)))
            self.radius.append(r)
        cell = codes[0] * len(books[1]) + codes[1]
        by = np.lexsort((ids, cell))
        self.ids, self.labels, self.x = ids[by], labels[by], x[by]
        self.size = np.sqrt((self.x * self.x).sum(1))
        at = np.searchsorted(cell[by], np.arange(len(books[0]) * len(books[1]) + 1))
        self.at = at.tolist()

    def half_bounds(self, q: np.ndarray) -> list[np.ndarray]:
        """Upper bounds of the half scores of each code: one row an anchor of ``q``."""
        out = []
        for part, c, r in zip((q[:, :self.half], q[:, self.half:]), self.books, self.radius):
            reach = np.sqrt((part * part).sum(1))[:, None]
            dot = part @ c.T
            slack = 1e-9 * (np.abs(dot) + reach * (np.where(r > 0, r, 0) + np.sqrt((c * c).sum(1)))) + 1e-6
            with np.errstate(invalid="ignore"):
                out.append(np.where(np.isneginf(r), -np.inf, dot + reach * np.where(np.isneginf(r), 0, r) + slack))
        return out

    def cells(self, first: np.ndarray, second: np.ndarray):
        """(bound, from, to) of the non-empty lists by falling bound: a heap over both sorted codebooks."""
        by = [np.argsort(-b, kind="stable") for b in (first, second)]
        tops = [b[o] for b, o in zip((first, second), by)]
        tops = [t[~np.isneginf(t)].tolist() for t in tops]
        rows, columns = by[0].tolist(), by[1].tolist()
        a, b = tops
        if not a or not b:
            return
        width, at = len(self.books[1]), self.at
        heap = [(-(a[0] + b[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            k = rows[i] * width + columns[j]
            if at[k] < at[k + 1]:
                yield -bound, at[k], at[k + 1]
            if j + 1 < len(b):
                heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(a):  # each pair is pushed by one neighbour only
                heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))

    def visit(self, q: np.ndarray, q_size: float, first: np.ndarray, second: np.ndarray):
        """(next bound, rows, scores) of block after block of lists; the last next bound is -inf."""
        wait, size = [], 0
        for bound, lo, hi in self.cells(first, second):
            if size >= BLOCK_ROWS:
                yield bound, *self._scored(wait, q, q_size)
                wait, size = [], 0
            wait.append((lo, hi))
            size += hi - lo
        if wait:
            yield -np.inf, *self._scored(wait, q, q_size)

    def _scored(self, lists, q, q_size):
        rows = np.concatenate([np.arange(lo, hi) for lo, hi in lists])
        return rows, scores_of(self.x[rows], self.size[rows], q, q_size)


def _best(ids: np.ndarray, scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    by = np.lexsort((ids, -scores))[:n]
    return ids[by], scores[by]


def positives_in(index: Index, anchor: int, q: np.ndarray, q_size: float, bounds, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n best other rows of an index of the anchor's label; certified when the n-th is above the next bound."""
    ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for after, rows, s in index.visit(q, q_size, *bounds):
        ok = index.ids[rows] != anchor
        ids, scores = _best(np.r_[ids, index.ids[rows][ok]], np.r_[scores, s[ok]], n)
        if len(scores) == n and scores[-1] > after:
            break
    return ids, scores


def negatives_in(index: Index, label: int, q: np.ndarray, q_size: float, bounds, positive: list[int], n: int,
                 low: int, high: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each positive score the n best rows of other labels inside its window."""
    found = {p: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for p in positive}
    # whole scores: low * p <= 100 * s <= high * p
    windows = {p: (-((-low * p) // 100), (high * p) // 100) for p in positive}
    open_ = set(found)
    for after, rows, s in index.visit(q, q_size, *bounds):
        some = np.flatnonzero((s >= min(windows[p][0] for p in open_)) & (s <= max(windows[p][1] for p in open_)))
        some = some[index.labels[rows[some]] != label]
        ids, s = index.ids[rows[some]], s[some]
        for p in list(open_):
            lo, hi = windows[p]
            ok = (s >= lo) & (s <= hi)
            if ok.any():
                found[p] = _best(np.r_[found[p][0], ids[ok]], np.r_[found[p][1], s[ok]], n)
            best = found[p][1]
            if after < lo or hi < lo or (len(best) == n and best[-1] > after):
                open_.discard(p)  # certified
        if not open_:
            break
    return found


class _Rows:
    """The index rows of the shard that a task is in; anchors follow them."""

    def __init__(self):
        self.parts: list[tuple] = []

    def add(self, ids, labels, x):
        self.parts.append((ids, labels, x))

    def gathered(self):
        ids, labels, x = (np.concatenate(c) for c in zip(*self.parts))
        by = np.lexsort((*x.T[::-1], labels, ids))
        ids, labels, x = ids[by], labels[by], x[by]
        same = (ids[1:] == ids[:-1]) & (labels[1:] == labels[:-1]) & (x[1:] == x[:-1]).all(1)
        new = np.r_[True, ~same] if len(ids) else np.zeros(0, bool)
        return ids[new], labels[new], x[new]


def _pass(spark, rows: DataFrame, anchors: DataFrame, dim: int, shards: int, books, schema: str, make, answer) -> DataFrame:
    """Streams the anchors of every shard past the shard's index: ``make(ids, labels, x)`` builds, ``answer`` yields columns."""
    held = spark.sparkContext.broadcast(books)
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    both = (rows.select(shard.alias("shard"), F.lit(0).alias("kind"), "vec_id", "label", "v", F.lit(None).cast("array<long>").alias("more"))
            .unionByName(anchors.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"),
                                        "vec_id", "label", "v", "more")))
    dealt = both.repartition(shards, "shard").sortWithinPartitions("shard", "kind")

    def run(batches):
        at, waiting, index = None, None, None
        for b in batches:
            if not b.num_rows:
                continue
            key = np.asarray(b.column(0), dtype=np.int64) * 2 + np.asarray(b.column(1))
            cuts = np.r_[0, np.flatnonzero(key[1:] != key[:-1]) + 1, len(key)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                shard_, kind = divmod(int(key[lo]), 2)
                if shard_ != at:
                    at, waiting, index = shard_, _Rows(), None
                part = b.slice(lo, hi - lo)
                x = np.asarray(part.column(4).flatten(), dtype=np.float64).reshape(hi - lo, dim)
                ids, labels = np.asarray(part.column(2)), np.asarray(part.column(3))
                if kind == 0:
                    waiting.add(ids, labels, x)
                elif waiting.parts:
                    if index is None:
                        index = make(*waiting.gathered(), held.value)
                    yield from answer(index, ids, labels, x, part.column(5))

    return dealt.mapInArrow(run, schema)


def _same_label_indexes(ids, labels, x, books):
    return {int(label): Index(ids[labels == label], labels[labels == label], x[labels == label], books) for label in np.unique(labels)}


def _answers_of_positives(n: int):
    def answer(indexes, ids, labels, x, _):
        size, out = np.sqrt((x * x).sum(1)), []
        for label in np.unique(labels):
            if (index := indexes.get(int(label))) is None:
                continue
            mine = np.flatnonzero(labels == label)
            first, second = index.half_bounds(x[mine])
            for r, a, b in zip(mine.tolist(), first, second):
                got, scores = positives_in(index, int(ids[r]), x[r], float(size[r]), (a, b), n)
                out.append((np.full(len(got), ids[r]), got, scores))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)],
                                             ["anchor_id", "positive_id", "positive_score"])
    return answer


def _answers_of_negatives(n: int, low: int, high: int):
    def answer(index, ids, labels, x, windows):
        size, out = np.sqrt((x * x).sum(1)), []
        first, second = index.half_bounds(x)
        for r, scores in enumerate(windows.to_pylist()):
            found = negatives_in(index, int(labels[r]), x[r], float(size[r]), (first[r], second[r]), sorted(set(scores)), n, low, high)
            for p, (got, s) in found.items():
                out.append((np.full(len(got), ids[r]), np.full(len(got), p), got, s))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)],
                                             ["anchor_id", "positive_score", "negative_id", "negative_score"])
    return answer


def _mine_length(spark, rows: DataFrame, dim: int, n_rows: int, scratch: Scratch, every: int, positives: int, negatives: int,
                 low: int, high: int, shard_rows: int) -> DataFrame:
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-n_rows // shard_rows), min(parts, n_rows // LEAST_SHARD_ROWS))  # each shard answers every anchor
    sample = rows.select("v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    codes = max(2, min(MAX_CODES, int(np.sqrt(n_rows / shards / LIST_ROWS))))
    books = codebooks(np.array([r.v for r in sample], dtype=np.float64).reshape(len(sample), dim), codes)
    anchors = scratch.store(rows.where(F.col("vec_id") % every == 0).distinct(), "anchors")

    near = _pass(spark, rows, anchors.withColumn("more", F.lit(None).cast("array<long>")), dim, shards, books,
                 "anchor_id long, positive_id long, positive_score long", _same_label_indexes, _answers_of_positives(positives))
    by = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    pairs = scratch.store(near.distinct().withColumn("k", F.row_number().over(by)).where(F.col("k") <= positives).drop("k"), "pairs")

    windows = pairs.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_set("positive_score").alias("more"))  # at most ``positives``
    far = _pass(spark, rows, anchors.join(windows, "vec_id"), dim, shards, books,
                "anchor_id long, positive_score long, negative_id long, negative_score long", Index,
                _answers_of_negatives(negatives, low, high))
    by = Window.partitionBy("anchor_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    ranked = far.distinct().withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= negatives)
    return pairs.join(ranked, ["anchor_id", "positive_score"])


def mine(vectors: DataFrame, label: Column | str = "label", every: int = EVERY, positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id and embedding; ``label`` is a column or an expression
    over the table.  Several different rows may share an id: each is a row, and
    as anchors their answers are those of the id.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "negatives")
    rows = scratch.store(whole_numbers(vectors, F.col(label) if isinstance(label, str) else label), "rows")
    out = None
    for r in sorted(rows.groupBy(F.size("v").alias("d")).count().collect()):  # few lengths
        some = _mine_length(spark, rows.where(F.size("v") == r["d"]), r["d"], r["count"], scratch, every, positives, negatives,
                            low, high, shard_rows)
        out = some if out is None else out.unionByName(some)
    if out is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
