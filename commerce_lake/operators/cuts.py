"""Exact ntiles without a sort: the k - 1 cut keys of every score are narrowed
down by counting passes, then each row is compared with them.

A tile of ``ntile(k) OVER (ORDER BY ...)`` ends at a known rank, so all that is
needed is the key at that rank:

1. a bracket (lo, hi] of keys holds the wanted rank; at first it is everything;
2. about ``sample`` keys of the bracket, chosen by a hash of the key, propose a
   narrower bracket around the rank's place;
3. one aggregate counts the rows below and inside the proposal, so the new
   bracket is exact whatever the sample was (a miss takes the side that holds
   the rank);
4. a bracket of at most ``sample`` rows is read and its key picked.

A pass shrinks a bracket by about the square root of ``sample`` over four, and
all scores share its two scans.  The driver holds 2 x ``sample`` keys a cut at
most, expected; no row is shuffled, no partition has to hold a value's rows, and
a value shared by a third of the rows is cut inside by the columns after it.

Keys are compared column by column, ascending, nulls last.  The order must be
total (end in a unique column).  Floating-point columns are refused: their NaN
has no place in the driver's order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import ceil, floor, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.session import ensure_checkpoint_dir

SAMPLE = 2048
PASSES = 64
_GRAIN = 1 << 30


@dataclass
class _Bracket:
    """Keys in (lo, hi] of one score; ``rank`` is the cut's place among all rows, from 1."""

    score: str
    rank: int
    below: int
    inside: int
    lo: tuple | None = None
    hi: tuple | None = None

    def holds(self, key: tuple) -> bool:
        return (self.lo is None or key > self.lo) and (self.hi is None or key <= self.hi)


class _Keys:
    """The order of one score, for Spark (structs) and for the driver (tuples)."""

    def __init__(self, df: DataFrame, cols: Sequence[str]):
        types = dict(df.dtypes)
        for c in cols:
            if types[c] in ("float", "double"):
                raise TypeError(f"column {c}: cuts need an exact type, got {types[c]}")
        self.cols, self.types = list(cols), types

    def column(self) -> Column:
        parts = []
        for i, c in enumerate(self.cols):
            parts += [F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}")]
        return F.struct(*parts)

    def literal(self, key: tuple) -> Column:
        parts = []
        for i, c in enumerate(self.cols):
            parts += [F.lit(key[2 * i]).alias(f"n{i}"), F.lit(key[2 * i + 1]).cast(self.types[c]).alias(f"v{i}")]
        return F.struct(*parts)

    def passed(self, borders: Sequence[tuple]) -> Column:
        """How many of the borders lie below the key."""
        if not borders:
            return F.lit(0)
        key = self.column()
        return F.size(F.filter(F.array(*[self.literal(b) for b in borders]), lambda b: b < key))

    def place(self, seed: int) -> Column:
        """A hash of the key in [0, _GRAIN)."""
        return F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in self.cols]), F.lit(_GRAIN))


class _Grid:
    """The borders of some brackets of all scores, sorted: a key's place among them tells its brackets."""

    def __init__(self, keys: Mapping[str, _Keys], spans: Sequence[tuple[str, tuple | None, tuple | None]]):
        self.keys, self.scores = keys, list(dict.fromkeys(s for s, _, _ in spans))
        self.borders = {s: sorted({x for t, *ends in spans if t == s for x in ends if x is not None}) for s in self.scores}

    def placed(self, df: DataFrame, seed: int | None = None) -> DataFrame:
        """p<i>, the place in score i's borders; with a seed also k<i> and h<i>, its key and the key's hash."""
        cols = [self.keys[s].passed(self.borders[s]).alias(f"p{i}") for i, s in enumerate(self.scores)]
        if seed is not None:
            cols += [self.keys[s].column().alias(f"k{i}") for i, s in enumerate(self.scores)]
            cols += [self.keys[s].place(seed).alias(f"h{i}") for i, s in enumerate(self.scores)]
        return df.select(*cols)

    def within(self, score: str, lo: tuple | None, hi: tuple | None) -> Column:
        held = self.borders[score]
        first = 0 if lo is None else held.index(lo) + 1
        last = len(held) if hi is None else held.index(hi)
        return F.col(f"p{self.scores.index(score)}").between(first, last)


def _read(df: DataFrame, keys: Mapping[str, _Keys], brackets: Sequence[_Bracket], rates: Sequence[int],
          seed: int) -> list[list[tuple]]:
    """Per bracket, in order, its keys whose hash is below the bracket's rate."""
    grid = _Grid(keys, [(b.score, b.lo, b.hi) for b in brackets])
    wanted = F.lit(False)
    for b, rate in zip(brackets, rates):
        wanted = wanted | (grid.within(b.score, b.lo, b.hi) & (F.col(f"h{grid.scores.index(b.score)}") < rate))
    rows = grid.placed(df, seed).where(wanted).collect()
    out = []
    for b, rate in zip(brackets, rates):
        i = grid.scores.index(b.score)
        out.append(sorted(k for k in (tuple(r[f"k{i}"]) for r in rows if r[f"h{i}"] < rate) if b.holds(k)))
    return out


def _proposal(b: _Bracket, found: list[tuple]) -> tuple[tuple | None, tuple | None]:
    """A narrower bracket: four standard errors around the rank's place in the sample, half of it at most."""
    m, p = len(found), (b.rank - b.below) / b.inside
    d = min(4 * sqrt(m * p * (1 - p)) + 1, m / 4)
    lo, hi = floor(m * p - d), ceil(m * p + d)
    return (found[lo] if 0 <= lo < m else b.lo), (found[hi] if 0 <= hi < m else b.hi)


def _narrowed(b: _Bracket, lo: tuple | None, hi: tuple | None, under: int, inside: int) -> _Bracket:
    """The part of ``b`` that holds its rank: under (lo0, lo], inside (lo, hi] or beyond (hi, hi0]."""
    if b.rank <= b.below + under:
        return _Bracket(b.score, b.rank, b.below, under, b.lo, lo)
    if b.rank <= b.below + under + inside:
        return _Bracket(b.score, b.rank, b.below + under, inside, lo, hi)
    return _Bracket(b.score, b.rank, b.below + under + inside, b.inside - under - inside, hi, b.hi)


def cut_keys(df: DataFrame, k: int, scores: Mapping[str, Sequence[str]], sample: int = SAMPLE) -> dict[str, list[tuple]]:
    """Per score, the keys of the last rows of tiles 1 .. k-1 that hold rows (empty for an empty table).

    ``df`` is read several times: it should be a stored table."""
    keys = {s: _Keys(df, cols) for s, cols in scores.items()}
    n = df.count()
    ends = [j * (n // k) + min(j, n % k) for j in range(1, k)]
    todo = [_Bracket(s, rank, 0, n) for s in scores for rank in ends if n]
    done: list[_Bracket] = []
    for seed in range(PASSES):
        done += [b for b in todo if b.inside <= sample]
        todo = [b for b in todo if b.inside > sample]
        if not todo:
            break
        rates = [ceil(_GRAIN * sample / b.inside) for b in todo]
        proposed = [_proposal(b, found) for b, found in zip(todo, _read(df, keys, todo, rates, seed))]
        grid = _Grid(keys, [x for b, (lo, hi) in zip(todo, proposed) for x in ((b.score, b.lo, lo), (b.score, lo, hi))])
        counts = []
        for i, (b, (lo, hi)) in enumerate(zip(todo, proposed)):
            under = F.lit(False) if lo == b.lo else grid.within(b.score, b.lo, lo)
            counts += [F.count_if(under).alias(f"u{i}"), F.count_if(grid.within(b.score, lo, hi)).alias(f"i{i}")]
        got = grid.placed(df).agg(*counts).first()
        todo = [_narrowed(b, lo, hi, got[f"u{i}"], got[f"i{i}"]) for i, (b, (lo, hi)) in enumerate(zip(todo, proposed))]
    if todo:
        raise ValueError(f"the order of {sorted({b.score for b in todo})} is not total: more than {sample} rows share a key")
    out: dict[str, list[tuple]] = {s: [] for s in scores}
    for b, found in zip(done, _read(df, keys, done, [_GRAIN] * len(done), 0)) if done else ():
        out[b.score].append(found[b.rank - b.below - 1])
    return {s: sorted(cuts) for s, cuts in out.items()}


def cut_ntiles(df: DataFrame, k: int, scores: Mapping[str, Sequence[str]], sample: int = SAMPLE) -> DataFrame:
    """``ntile(k) OVER (ORDER BY cols ASC NULLS LAST)`` for every entry ``out column: cols`` of ``scores``.

    ``df`` is checkpointed once (reliable), so that all passes and the result see the same rows."""
    ensure_checkpoint_dir(df.sparkSession)
    held = df.checkpoint(eager=True)
    cuts = cut_keys(held, k, scores, sample)
    return held.withColumns({s: _Keys(held, cols).passed(cuts[s]) + 1 for s, cols in scores.items()})
