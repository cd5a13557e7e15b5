"""Toxicity: a subsequence string-kernel support vector machine with Nystroem landmarks.

Units are words: white-space tokens, lower-cased and stripped of outer
punctuation; a token with characters inserted between its letters also counts
without them, a run of single characters ("x y z") counts as one word too, and
a very long token is cut into overlapping pieces, so the whole text is covered.

Kernel: gap-weighted subsequences of three characters.  A triple that spans n
characters (n at most ``SPAN``) weighs ``DECAY ** n``, so inserted or skipped
characters lower the similarity and do not end it; word borders are characters.
K(u, v) is the inner product of the triples' weights over both norms.

Learning (a bounded labelled sample, see ``PER_CLASS``) is multiple-instance: a
toxic text has at least one toxic word, a clean one has none.  Landmarks are
the words with the strongest label evidence and the most frequent clean words;
a unit's Nystroem features are K_mm^(-1/2) K(u, landmarks); a linear
hinge-loss machine on them is trained on each toxic text's highest word against
the clean texts' words, in rounds that choose those words anew.  A text's
margin is that of its highest word; a logistic curve fitted on the sample turns
it into the score.

Scoring is row-local and without a shuffle.  Machine and landmarks collapse to
one weight per triple, so a word costs a few table look-ups; a worker keeps the
margins of words that it has met in a bounded cache.

Defined cases: a null, empty or word-less text has the lowest margin; without
both labels in the sample every score is the share of label 1 (0 without rows);
ties are broken by text order; repeated rows score alike; empty tables give no
rows; further columns are ignored by ``score`` and kept by ``drop_toxic``.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import labelled_texts, remainder

DECAY, SPAN, PIECE, STEP = 0.6, 6, 24, 16
LANDMARKS, ROUNDS = 192, 5
PER_CLASS = {0: 1800, 1: 1500}
HELD_OUT_MOD, HELD_OUT = 3, 1
THRESHOLD = 0.7
SYMBOLS = 128
CACHE_WORDS = 500_000

SPACED = re.compile(r"(?<!\S)\w(?:\s\w){2,}(?!\S)")
OUTER = re.compile(r"^[\W_]+|[\W_]+$")
INNER = re.compile(r"[\W_]+")
#: Place offsets (j, k) after a triple's first character, and the decay of its span.
OFFSETS = [(j, k) for k in range(2, SPAN) for j in range(1, k)]


def tokens(text: str | None) -> set[str]:
    low = (text or "").lower()
    out = set(low.split())
    for m in SPACED.finditer(low):
        out.add("".join(m.group().split()))
    return out


def units(token: str) -> list[str]:
    """The words that one token stands for."""
    word = OUTER.sub("", token)
    out = [word]
    if (plain := INNER.sub("", word)) != word:
        out.append(plain)
    pieces = []
    for w in out:
        if len(w) <= PIECE:
            pieces.append(w)
        else:
            pieces += [w[i:i + PIECE] for i in range(0, len(w) - PIECE + STEP, STEP)]
    return [w for w in pieces if len(w) > 1]


class Triples:
    """Weighted triples of words, over a fixed alphabet; other characters share symbol 0, which matches nothing."""

    def __init__(self, alphabet: str):
        self.index = {c: i + 2 for i, c in enumerate(alphabet[:SYMBOLS - 2])}

    def encode(self, words: list[str]) -> np.ndarray:
        """(len(words), longest + 2) symbols, 1 as border on both sides, -1 after the end."""
        n = max(map(len, words)) + 2
        out = np.full((len(words), n), -1, dtype=np.int32)
        get = self.index.get
        for r, w in enumerate(words):
            out[r, :len(w) + 2] = [1, *(get(c, 0) for c in w), 1]
        return out

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Keys (-1: none) and weights, a row a word."""
        s = self.encode(words)
        n = s.shape[1]
        keys, weights = [], []
        for j, k in OFFSETS:
            if n <= k:
                continue
            a, b, c = s[:, :n - k], s[:, j:n - k + j], s[:, k:]
            key = (a * SYMBOLS + b) * SYMBOLS + c
            # an unknown character matches nothing but keeps its share of the norm: a key of its own
            key = np.where((a > 0) & (b > 0) & (c > 0), key, -2 - (key & 0xFFFFF))
            keys.append(np.where(c < 0, -1, key))
            weights.append(np.full(key.shape, DECAY ** (k + 1)))
        if not keys:
            return np.full((len(words), 1), -1), np.zeros((len(words), 1))
        key, weight = np.concatenate(keys, 1), np.concatenate(weights, 1)
        return key, np.where(key == -1, 0.0, weight)

    @staticmethod
    def norms(key: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """sqrt(K(u, u)): triples that occur several times in a word add up before squaring."""
        order = np.argsort(key, axis=1, kind="stable")
        k, w = np.take_along_axis(key, order, 1), np.take_along_axis(weight, order, 1)
        new = np.ones(k.shape, dtype=bool)
        new[:, 1:] = k[:, 1:] != k[:, :-1]
        sums = np.add.reduceat(w.ravel(), np.flatnonzero(new.ravel()))
        rows = np.repeat(np.arange(len(k)), new.sum(1))
        return np.sqrt(np.maximum(np.bincount(rows, sums * sums, minlength=len(k)), 1e-12))


def _by_length(words: list[str], size: int = 4096):
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    for at in range(0, len(order), size):
        yield order[at:at + size]


class Model:
    """score(text): margins come from one weight per triple (``table``)."""

    def __init__(self, triples: Triples, table: np.ndarray, bias: float, slope: float, shift: float):
        self.triples, self.table, self.bias, self.slope, self.shift = triples, table, bias, slope, shift
        self.cache: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def margins(self, words: list[str]) -> np.ndarray:
        out = np.full(len(words), self.bias)
        for idx in _by_length(words):
            key, weight = self.triples.of([words[i] for i in idx])
            up = np.where(key >= 0, self.table[np.maximum(key, 0)], 0.0)
            out[idx] = (up * weight).sum(1) / self.triples.norms(key, weight) + self.bias
        return out

    def learn_words(self, toks) -> None:
        """Margins of new tokens into the cache (the highest of each token's units)."""
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        new = [t for t in toks if t not in self.cache]
        pairs = [(t, u) for t in new for u in units(t)]
        for t in new:
            self.cache[t] = -np.inf
        if pairs:
            for (t, _), m in zip(pairs, self.margins([u for _, u in pairs])):
                if m > self.cache[t]:
                    self.cache[t] = float(m)

    def margin(self, toks: set[str]) -> float:
        self.learn_words(toks)
        return max(map(self.cache.__getitem__, toks), default=-np.inf)

    def probability(self, margin: float) -> float:
        z = self.slope * max(margin, self.bias - 1.0) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def scores(self, texts: list[str | None]) -> list[float]:
        bags = [tokens(t) for t in texts]
        for at in range(0, len(bags), 64):  # new words of several texts at once
            self.learn_words(set().union(*bags[at:at + 64]))
            for i, bag in enumerate(bags[at:at + 64], at):
                bags[i] = self.probability(self.margin(bag))
        return bags


class Constant:
    def __init__(self, p: float):
        self.p = p

    def scores(self, texts):
        return [self.p] * len(texts)


def _hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-5) -> tuple[np.ndarray, float]:
    """Squared-hinge linear machine by Newton steps on the active rows; the bias is not penalised."""
    xb = np.hstack([x, np.ones((len(x), 1))])
    reg = np.append(np.full(x.shape[1], penalty), 1e-9)

    def loss(w):
        return (weight * np.maximum(0, 1 - y * (xb @ w)) ** 2).sum() + (reg * w * w).sum()

    w = np.zeros(xb.shape[1])
    for _ in range(50):
        on = y * (xb @ w) < 1
        xa, wa = xb[on], weight[on]
        full = np.linalg.solve((xa * wa[:, None]).T @ xa + np.diag(reg), (xa * wa[:, None]).T @ y[on])
        step, now = 1.0, loss(w)
        while step > 1e-4 and loss(w + step * (full - w)) > now:
            step /= 2
        if now - loss(w + step * (full - w)) < 1e-10:
            break
        w = w + step * (full - w)
    return w[:-1], float(w[-1])


def _platt(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve of label on margin, with Platt's smoothed targets; the two classes weigh alike."""
    pos, neg = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    weight = np.where(y == 1, 0.5 / pos, 0.5 / neg)
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        g = np.array([((p - target) * weight * m).sum() + 1e-5 * a, ((p - target) * weight).sum()])
        c = np.maximum(p * (1 - p), 1e-6) * weight
        h = np.array([[(c * m * m).sum() + 1e-5, (c * m).sum()], [(c * m).sum(), c.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        step *= min(1, 5 / max(np.abs(step).max(), 1e-12))
        a, b = a - step[0], b - step[1]
    return float(a), float(b)


def units_of(text: str | None) -> list[str]:
    """The different words of a text, sorted."""
    return sorted({u for t in tokens(text) for u in units(t)})


def fit(rows: list[tuple[str, int]], landmarks: int = LANDMARKS) -> Model | Constant:
    """A model from (text, label) rows; deterministic in the order of ``rows``."""
    return fit_bags(pa.array([units_of(t) for t, _ in rows], pa.list_(pa.string())), np.array([y for _, y in rows], dtype=int), landmarks)


def fit_bags(bags: pa.ListArray, y: np.ndarray, landmarks: int = LANDMARKS) -> Model | Constant:
    """A model from the texts' words (without repeats) and labels.

    Held at a time: the words as one Arrow dictionary, a number per word of each
    text, a margin per word, and kernel rows for the words that train.
    """
    if not len(y) or y.min() == y.max():
        return Constant(float(y.mean()) if len(y) else 0.0)
    coded = bags.values.dictionary_encode()
    vocabulary = coded.dictionary.to_pylist()
    by_text = sorted(range(len(vocabulary)), key=vocabulary.__getitem__)
    number = np.empty(len(vocabulary), dtype=np.int32)
    number[by_text] = np.arange(len(by_text), dtype=np.int32)  # words are numbered in text order, which breaks ties
    vocabulary = [vocabulary[i] for i in by_text]
    codes, at = number[np.asarray(coded.indices)] if len(vocabulary) else np.zeros(0, np.int32), np.asarray(bags.offsets)
    members = [codes[lo:hi] for lo, hi in zip(at[:-1], at[1:])]
    label_of = np.repeat(y, np.diff(at))
    df = [np.bincount(codes[label_of == c], minlength=len(vocabulary)) for c in (0, 1)]
    n_docs = [(y == 0).sum(), (y == 1).sum()]
    # texts with the word times its log lift over the clean texts, beyond a lift of 3
    evidence = df[1] * np.log((df[1] + 0.5) / n_docs[1] * n_docs[0] / (df[0] + 0.5) / 3)
    toxic = np.argsort(-evidence, kind="stable")[:landmarks // 2]
    toxic = toxic[evidence[toxic] > 0]
    if not len(toxic):
        return Constant(float(y.mean()))
    common = np.argsort(-df[0], kind="stable")
    common = common[df[0][common] > 0]
    clean = common[~np.isin(common, toxic)][:landmarks - len(toxic)]
    marks = [vocabulary[i] for i in (*toxic, *clean)]
    letters = Counter(c for w in marks for c in w)
    triples = Triples("".join(sorted(letters, key=lambda c: (-letters[c], c))))

    size = SYMBOLS ** 3
    key, weight = triples.of(marks)
    used = np.unique(key[key >= 0])
    row_of = np.zeros(size, dtype=np.int32)
    row_of[used] = np.arange(1, len(used) + 1)
    maps = np.zeros((len(used) + 1, len(marks)), dtype=np.float32)  # triple weights of each normalised landmark
    for j, n in enumerate(triples.norms(key, weight)):
        ok = key[j] >= 0
        np.add.at(maps[:, j], row_of[key[j][ok]], weight[j][ok] / n)

    def kernel(words: list[str], columns: np.ndarray = maps) -> np.ndarray:
        out = np.zeros((len(words), columns.shape[1]), dtype=np.float32)
        for idx in _by_length(words, 64):
            k, w = triples.of([words[i] for i in idx])
            norm = triples.norms(k, w)
            rows_ = np.where(k >= 0, row_of[np.maximum(k, 0)], 0)
            out[idx] = np.einsum("rt,rtm->rm", w.astype(np.float32), columns[rows_]) / norm[:, None]
        return out

    kmm = kernel(marks).astype(float)
    val, vec = np.linalg.eigh((kmm + kmm.T) / 2)
    half = vec @ np.diag(np.where(val > 1e-4, 1 / np.sqrt(np.maximum(val, 1e-4)), 0.0)) @ vec.T  # K_mm^(-1/2)
    strength = np.sqrt(evidence[toxic] / evidence[toxic[0]])
    toxic_maps = np.ascontiguousarray(maps[:, :len(toxic)])
    margin = np.empty(len(vocabulary))
    for lo in range(0, len(vocabulary), 8192):
        margin[lo:lo + 8192] = (kernel(vocabulary[lo:lo + 8192], toxic_maps) * strength).max(1)

    model = None
    # a toxic text's witness has to be rarer in clean texts; texts without such a word teach nothing
    witnesses_of = [m[evidence[m] > 0] for m, label in zip(members, y) if label == 1]
    met = Counter()
    for _ in range(ROUNDS):
        top = [m[np.argmax(margin[m])] for m in witnesses_of if len(m)]
        worst = [m[np.argsort(-margin[m], kind="stable")[:3]] for m, label in zip(members, y) if len(m) and label == 0]
        witnesses, times = np.unique(np.array(top, dtype=int), return_counts=True)
        met += Counter(np.concatenate(worst).tolist()) if worst else Counter()  # hard negatives stay once met
        against = np.array(sorted(set(common[:4000].tolist()) | set(met)), dtype=int)
        if not len(witnesses) or not len(against):
            return Constant(float(y.mean()))
        idx = np.concatenate([witnesses, against])
        sign = np.r_[np.ones(len(witnesses)), -np.ones(len(against))]
        often = np.array([1.0 + met[i] for i in against.tolist()])
        balance = np.r_[0.5 * times / times.sum(), 0.5 * often / often.sum()]
        w, bias = _hinge(kernel([vocabulary[i] for i in idx]).astype(float) @ half, sign, balance)
        table = np.zeros(size, dtype=np.float32)
        table[used] = maps[1:] @ (half @ w)
        model = Model(triples, table, bias, 1.0, 0.0)
        margin = model.margins(vocabulary)
    doc = np.array([margin[m].max() if len(m) else bias - 1.0 for m in members])
    model.slope, model.shift = _platt(np.maximum(doc, bias - 1.0), y)
    return model


def labelled_bags(docs: DataFrame, labels: DataFrame, usable, per_class: dict[int, int]) -> tuple[pa.ListArray, np.ndarray]:
    """Words and label of the sample's rows, by id, label and words; the executors take the words out of the texts."""

    def run(batches):
        for b in batches:
            words = pa.array([units_of(t) for t in b.column(1).to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), words], ["doc_id", "y", "units"])

    rows = (labelled_texts(docs, labels, "toxic", usable, per_class).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "y")
            .mapInArrow(run, "doc_id long, y int, units array<string>")
            .select("doc_id", "y", "units", F.xxhash64("units").alias("h")).toArrow().combine_chunks())
    keys = [rows.column(c).to_pylist() for c in ("doc_id", "y", "h")]
    # equal rows count once
    order = sorted({k: i for i, k in reversed(list(enumerate(zip(*keys))))}.items())
    taken = rows.take(pa.array([i for _, i in order], pa.int64()))
    bags = taken.column("units").combine_chunks()
    return bags.chunk(0) if isinstance(bags, pa.ChunkedArray) else bags, np.array([k[1] for k, _ in order], dtype=int)


def train(docs: DataFrame, labels: DataFrame, usable=None) -> Model | Constant:
    usable = usable or (lambda i: remainder(i, HELD_OUT_MOD) != HELD_OUT)
    return fit_bags(*labelled_bags(docs, labels, usable, PER_CLASS))


def score(docs: DataFrame, model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                s = m.scores(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(s, pa.float64()), pa.array([int(v >= threshold) for v in s], pa.int32())],
                    ["doc_id", "score", "predicted"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, score double, predicted int"))


def drop_toxic(docs: DataFrame, model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, that the model does not reject (row-local, no join)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    at_text = docs.columns.index("text")

    def run(batches):
        m = held.value
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                keep = [v < threshold for v in m.scores(part.column(at_text).cast(pa.string()).to_pylist())]
                if any(keep):
                    yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
