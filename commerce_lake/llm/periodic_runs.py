"""Periodic runs of words, found with an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q and at least
``max(LEAST_WORDS, LEAST_PERIODS * q)`` words that no neighbouring word extends.

The words of a slice of texts form one array in which equal words of different
texts differ, so no comparison leaves its text.  Prefix doubling gives the
suffix array, its inverse and, through the ranks of each doubling, the LCP
array.  Every LCP border splits its interval in two; for each suffix i of the
smaller side, the inverse array tells whether the suffix at i + depth or
i - depth lies on the other side.  If it does, a square of that period stands
there and the word after it breaks it (a branching square): the square is
rotated to the left as far as its period holds, which gives the run, and the
runs of one stretch are merged into the one of smallest period.  Intervals are
borders of the LCP array; no tree is built.  All steps are array operations
over the slice; the sides tested add up to n log n.

``find_runs`` is row-local: no shuffle, no collect.

Defined cases: a null, empty or blank text has no words, no runs and an empty
collapsed text; a null doc_id is kept; repeated rows are rows of their own; one
very long text is a slice of its own; runs that overlap are all returned, and a
word goes if any of them drops it; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_WORDS, LEAST_PERIODS = 6, 4
SLICE_BYTES = 2 << 20
TESTS_AT_ONCE = 1 << 21
SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class SuffixArray:
    """order, its inverse ``place`` and ``lcp`` (lcp[k]: of order[k - 1] and order[k]; -1 at both ends).

    ``key`` holds a symbol a position, ``begin`` and ``end`` the bounds of the
    text that a position lies in; symbols of different texts differ.
    """

    def __init__(self, key: np.ndarray, end: np.ndarray):
        n = len(key)
        order = np.argsort(key, kind="stable")
        new = np.r_[True, key[order][1:] != key[order][:-1]]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        #: levels[j][i] == levels[j][m]: the 2 ** j words from i and from m on are equal
        self.levels = [rank.astype(np.int32)]
        step = 1
        while len(open_ := np.flatnonzero(~(new & np.r_[new[1:], True]))):
            i = order[open_]
            after = i + step
            pair = rank[i] * (n + 1) + np.where(after < end[i], rank[np.minimum(after, n - 1)] + 1, 0)
            by = np.argsort(pair, kind="stable")
            order[open_], pair = i[by], pair[by]
            new[open_] = cut = np.r_[True, pair[1:] != pair[:-1]]
            rank[order[open_]] = np.maximum.accumulate(np.where(cut, open_, 0))
            self.levels.append(rank.astype(np.int32))
            step *= 2
        self.order, self.place, self.end = order, rank, end
        self.lcp = np.full(n + 1, -1, dtype=np.int64)
        self.lcp[1:n] = self.common(order[:-1], order[1:])

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal words from positions a and b on."""
        out, last = np.zeros(len(a), dtype=np.int64), len(self.place) - 1
        stop = np.minimum(self.end[a] - a, self.end[b] - b)
        for j in reversed(range(len(self.levels))):
            level = self.levels[j]
            same = (out < stop) & (level[np.minimum(a + out, last)] == level[np.minimum(b + out, last)])
            out += np.where(same, 1 << j, 0)
        return out

    def common_before(self, a: np.ndarray, b: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Number of equal words that end just before positions a and b; at most ``room`` of them exist before a."""
        out = np.zeros(len(a), dtype=np.int64)
        for j in reversed(range(len(self.levels))):
            level, back = self.levels[j], out + (1 << j)
            same = (back <= room) & (level[np.maximum(a - back, 0)] == level[np.maximum(b - back, 0)])
            out += np.where(same, 1 << j, 0)
        return out


def _nearest(value: np.ndarray, at: np.ndarray, step: int, stop) -> np.ndarray:
    """For each place the nearest one on the side of ``step`` where ``stop(there, here)`` holds; pointers double."""
    to = np.arange(len(value)) + step
    while len(at := at[~stop(value[to[at]], value[at])]):
        to[at] = to[to[at]]
    return to


def branching_squares(s: SuffixArray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of all squares whose period the next word breaks."""
    borders = np.flatnonzero(s.lcp > 0)
    # a border's interval: from the last border that is no higher to the next one that is lower
    low = _nearest(s.lcp, borders, -1, np.less_equal)[borders]
    high = _nearest(s.lcp, borders, 1, np.less)[borders]
    depth = s.lcp[borders]
    left_is_small = borders - low <= high - borders
    small = np.where(left_is_small, low, borders)
    size = np.where(left_is_small, borders - low, high - borders)
    other_lo, other_hi = np.where(left_is_small, borders, low), np.where(left_is_small, high, borders)
    starts, periods = [], []
    ends = np.cumsum(size)
    at = 0
    while at < len(borders):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TESTS_AT_ONCE, side="right")))
        n = size[at:stop]
        of = np.repeat(np.arange(at, stop), n)
        x = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + small[of]
        i, d = s.order[x], depth[of]
        for j, first in ((i + d, i), (i - d, i - d)):
            ok = np.flatnonzero((j >= begin[i]) & (j < s.end[i]))
            r = s.place[j[ok]]
            ok = ok[(r >= other_lo[of[ok]]) & (r < other_hi[of[ok]])]
            starts.append(first[ok])
            periods.append(d[ok])
        at = stop
    return (np.concatenate(starts), np.concatenate(periods)) if starts else (np.zeros(0, np.int64),) * 2


def runs_of(key: np.ndarray, begin: np.ndarray, end: np.ndarray, least_words: int = LEAST_WORDS,
            least_periods: int = LEAST_PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start and period."""
    if not len(key):
        return (np.zeros(0, dtype=np.int64),) * 3
    s = SuffixArray(key, end)
    at, period = branching_squares(s, begin)
    stop = at + 2 * period
    start = at - s.common_before(at, at + period, at - begin[at])  # rotations to the left
    by = np.lexsort((period, stop, start))
    start, stop, period = start[by], stop[by], period[by]
    first = np.r_[True, (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])] if len(start) else np.zeros(0, bool)
    start, length, period = start[first], (stop - start)[first], period[first]
    keep = length >= np.maximum(least_words, least_periods * period)
    start, length, period = start[keep], length[keep], period[keep]
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


def _slices(batch: pa.RecordBatch, size: int):
    at = total = 0
    for k, n in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
        if total and total + len(n or b"") > size:
            yield batch.slice(at, k - at)
            at, total = k, 0
        total += len(n or b"")
    if at < batch.num_rows:
        yield batch.slice(at)


def find_runs(docs: DataFrame, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; words from 0) and the collapsed text of every row.

    The collapsed text has the words, joined by one space, that no run contains
    after its first ``period`` words.  ``least_periods`` is 2 at least.
    """
    if least_periods < 2:
        raise ValueError("a run has two periods at least")

    def run(batches):
        for b in batches:
            for rows in _slices(b, SLICE_BYTES):
                yield found(rows)

    def found(rows):
        words = [(t or b"").split() for t in rows.column(1).cast(pa.binary()).to_pylist()]
        n = np.array([len(w) for w in words], dtype=np.int64)
        coded = pa.array(itertools.chain.from_iterable(words), pa.binary()).dictionary_encode()
        doc = np.repeat(np.arange(len(words)), n)
        ends = np.cumsum(n)
        key = doc * max(1, len(coded.dictionary)) + np.asarray(coded.indices, dtype=np.int64)
        start, length, period = runs_of(key, (ends - n)[doc], ends[doc], least_words, least_periods)
        first = np.searchsorted(start, np.r_[ends - n, ends[-1:]])  # of each text's runs
        for k in np.unique(doc[start]) if len(start) else ():
            drop = np.zeros(n[k] + 1, dtype=np.int64)
            mine = slice(first[k], first[k + 1])
            np.add.at(drop, start[mine] + period[mine] - (ends[k] - n[k]), 1)
            np.add.at(drop, start[mine] + length[mine] - (ends[k] - n[k]), -1)
            words[k] = list(itertools.compress(words[k], (np.cumsum(drop)[:-1] == 0).tolist()))
        local = start - (ends - n)[doc[start]] if len(start) else start
        runs = pa.StructArray.from_arrays([pa.array(local), pa.array(length), pa.array(period)], fields=list(_RUN))
        return pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(n), pa.ListArray.from_arrays(pa.array(first, pa.int32()), runs),
             pa.array([b" ".join(w) for w in words], pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def words_of(text: Column) -> Column:
    """The text's words, split at the six ASCII white-space characters; none for a null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def longest(runs: Column) -> Column:
    """The run of greatest length (ties: smallest start, then period); null without one."""
    order = F.transform(runs, lambda r: F.struct((-r["length"]).alias("k"), r["start"].alias("start"), r["period"].alias("period")))
    return F.array_min(order)
