"""Quality: random-indexing word vectors, pooled per document, and a two-layer network.

Tokens are words, numbers and runs of symbols of the whole text.  A token's
index vector is sparse and random (a few +-1 from a hash), plus one for its
shape (lower, Title, UPPER, number, symbols) and one if it repeats the token
before.  A word vector is the sum of the index vectors met within ``REACH``
tokens of the word, over all documents; words share ``BUCKETS`` hash buckets,
so the table has one size at any scale, and integer sums make it independent
of the order of addition.  A document is the mean of its tokens' normalised word vectors, the mean
of their index vectors, and its length.

The network (tanh, then a logistic unit) is trained in numpy on a bounded
labelled sample (``PER_CLASS``, classes weighted alike); a temperature fitted
on a part of the sample that training did not see calibrates the scores.
Labels, language, source and id are no inputs of a score.

Defined cases: a null, empty or blank text has zero vectors and length 0;
without both labels in the sample every score is the share of label 1 (0
without rows); repeated rows score alike; empty tables give no rows; further
columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import labelled_sample, remainder

BUCKETS, DIM, ONES, REACH = 8192, 48, 4, 2
SHAPES = 5  # lower, Title, UPPER, number, symbols
HIDDEN = 24
PER_CLASS = {0: 2000, 1: 3000}
HELD_OUT_MOD, HELD_OUT = 5, 0
THRESHOLD = 0.3
CACHE_TOKENS = 400_000
CHUNK = 1 << 18

TOKEN = re.compile(r"[^\W\d_]+|[\d_]+|[^\w\s]+")


def index_vectors() -> np.ndarray:
    """Sparse random +-1 rows: one per bucket, then one per shape, then the one for a repetition."""
    rng = np.random.default_rng(7)
    out = np.zeros((BUCKETS + SHAPES + 1, DIM), dtype=np.int8)
    for row in out:
        row[rng.choice(DIM, ONES, replace=False)] = rng.choice([-1, 1], ONES)
    return out


def _code(token: str) -> int:
    """bucket * SHAPES + shape."""
    if token[0].isalpha():
        shape = 0 if token.islower() else 2 if token.isupper() and len(token) > 1 else 1
    else:
        shape = 3 if token[0].isdigit() or token[0] == "_" else 4
    return zlib.crc32(token.lower().encode()) % BUCKETS * SHAPES + shape


class Codes(dict):
    def __missing__(self, token):
        if len(self) > CACHE_TOKENS:
            self.clear()
        self[token] = c = _code(token)
        return c


_codes = Codes()


def codes(text: str | None) -> np.ndarray:
    return np.fromiter(map(_codes.__getitem__, TOKEN.findall(text or "")), dtype=np.int64)


def _indexed(c: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The index vector of every token of one text."""
    x = index[c // SHAPES].astype(np.float32) + index[BUCKETS + c % SHAPES]
    same = np.zeros(len(c), dtype=bool)
    same[1:] = c[1:] == c[:-1]
    x[same] += index[BUCKETS + SHAPES]
    return x


def _contexts(x: np.ndarray) -> np.ndarray:
    """The sum of the vectors within REACH tokens of each token, itself excluded."""
    out = np.zeros_like(x)
    for o in range(1, REACH + 1):
        out[o:] += x[:-o]
        out[:-o] += x[o:]
    return out


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The word vectors (BUCKETS x DIM) summed over all documents."""

    def partial(batches):
        index = index_vectors()
        table = np.zeros((BUCKETS, DIM), dtype=np.float64)
        for b in batches:
            for t in b.column(0).to_pylist():
                c = codes(t)
                for at in range(0, len(c), CHUNK):  # a very long text in pieces that overlap by the reach
                    lo = max(0, at - REACH)
                    piece = c[lo:at + CHUNK + REACH]
                    ctx = _contexts(_indexed(piece, index))[at - lo:at - lo + CHUNK]
                    mine = piece[at - lo:at - lo + CHUNK] // SHAPES
                    order = np.argsort(mine, kind="stable")
                    starts = np.flatnonzero(np.r_[True, mine[order][1:] != mine[order][:-1]])
                    table[mine[order][starts]] += np.add.reduceat(ctx[order], starts, axis=0)
        used = np.flatnonzero(table.any(1))
        for at in range(0, len(used), 2048):
            rows = used[at:at + 2048]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * DIM, pa.int32()), pa.array(table[rows].ravel()))],
                ["bucket", "v"])

    def total(batches):
        table = np.zeros((BUCKETS, DIM), dtype=np.float64)
        for b in batches:
            np.add.at(table, np.asarray(b.column(0)), np.asarray(b.column(1).flatten()).reshape(-1, DIM))
        used = np.flatnonzero(table.any(1))
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1) * DIM, pa.int32()), pa.array(table[used].ravel()))],
                ["bucket", "v"])

    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(partial, "bucket int, v array<double>")
    rows = parts.repartition(8, "bucket").mapInArrow(total, "bucket int, v array<double>").collect()  # at most BUCKETS rows
    out = np.zeros((BUCKETS, DIM))
    for r in rows:
        out[r.bucket] = r.v
    return out


class Pooler:
    def __init__(self, vectors: np.ndarray):
        # frequent contexts say least: centre, then give every word unit length
        norm = np.sqrt((vectors ** 2).sum(1, keepdims=True))
        unit = np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 0)
        self.words = unit.astype(np.float32)
        self.index = index_vectors()

    def features(self, text: str | None) -> np.ndarray:
        c = codes(text)
        if not len(c):
            return np.zeros(2 * DIM + 1)
        word, own = np.zeros(DIM), np.zeros(DIM)
        for at in range(0, len(c), CHUNK):
            lo = max(0, at - 1)  # one token back, for the repetition mark
            piece = c[lo:at + CHUNK]
            word += self.words[c[at:at + CHUNK] // SHAPES].sum(0, dtype=np.float64)
            own += _indexed(piece, self.index)[at - lo:].sum(0, dtype=np.float64)
        return np.r_[word / len(c), own / len(c), np.log1p(len(c)) / 10]


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Network:
    """score(features): standardised inputs, tanh layer, logistic unit, temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, steps: int = 1500, decay: float = 1e-3, seed: int = 11):
        self.mean, self.std = x.mean(0), x.std(0) + 1e-6
        rng = np.random.default_rng(seed)
        fit = rng.permutation(len(y)) >= len(y) // 5
        z, t = (x - self.mean) / self.std, y.astype(float)
        weight = np.where(y == 1, 0.5 / max(1, (y[fit] == 1).sum()), 0.5 / max(1, (y[fit] == 0).sum()))
        p = {"a": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), "b": np.zeros(HIDDEN),
             "c": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "d": np.zeros(1)}
        m, v = ({k: np.zeros_like(w) for k, w in p.items()} for _ in range(2))
        zf, tf, wf = z[fit], t[fit], weight[fit]
        for i in range(1, steps + 1):
            h = np.tanh(zf @ p["a"] + p["b"])
            e = (_sigmoid(h @ p["c"] + p["d"]) - tf) * wf
            back = np.outer(e, p["c"]) * (1 - h * h)
            grad = {"a": zf.T @ back + decay * p["a"], "b": back.sum(0), "c": h.T @ e + decay * p["c"], "d": e.sum(keepdims=True)}
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * grad[k]
                v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
                p[k] = p[k] - 0.01 * (m[k] / (1 - 0.9 ** i)) / (np.sqrt(v[k] / (1 - 0.999 ** i)) + 1e-8)
        self.p, self.temperature = p, 1.0
        logit, tc, wc = self.logits(x[~fit]), t[~fit], weight[~fit]
        if len(tc):
            grid = np.exp(np.linspace(np.log(0.2), np.log(10), 80))
            loss = [-(wc * np.log(np.where(tc == 1, _sigmoid(logit / g), _sigmoid(-logit / g)) + 1e-12)).sum() for g in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.std, -8, 8)
        return np.tanh(z @ self.p["a"] + self.p["b"]) @ self.p["c"] + self.p["d"]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


class Model:
    def __init__(self, pooler: Pooler, network: Network | float):
        self.pooler, self.network = pooler, network

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if isinstance(self.network, float):
            return np.full(len(texts), self.network)
        return self.network.scores(np.array([self.pooler.features(t) for t in texts]))


def fit(rows: list[tuple[str, int]], vectors: np.ndarray) -> Model:
    pooler, y = Pooler(vectors), np.array([r[1] for r in rows], dtype=int)
    if not len(y) or y.min() == y.max():
        return Model(pooler, float(y.mean()) if len(y) else 0.0)
    return Model(pooler, Network(np.array([pooler.features(t) for t, _ in rows]), y))


def train(docs: DataFrame, labels: DataFrame, usable=None) -> Model:
    usable = usable or (lambda i: remainder(i, HELD_OUT_MOD) != HELD_OUT)
    return fit(labelled_sample(docs, labels, "quality", usable, PER_CLASS), word_vectors(docs))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted of every row (row-local)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                s = held.value.scores(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))],
                    ["doc_id", "score", "predicted"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, score double, predicted int"))
