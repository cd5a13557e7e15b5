"""Targets, rates and copies of the mix against direct computation."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from commerce_lake.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus():
    rng = np.random.default_rng(8)
    rows = []
    for i in range(600):
        source = None if i % 50 == 0 else "big" if i % 3 == 0 else f"s{i % 7}" if i % 11 else "Ürsula"
        n = int(rng.integers(0, 40)) if i % 97 else 4000
        rows.append((i, " ".join(["w"] * n), source))
    rows += [(601, None, "empty"), (602, " \t\n", "empty"), (603, "", None), (None, "a b c", "s1"), (None, "a b c", "s1"), (5, rows[5][1], rows[5][2]),
             (605, "\x0b one\x0ctwo\r\nthree\x85four five ", "tiny")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, source string, size int, target string")


def wanted_targets(rows):
    size = Counter()
    for _, t, s in rows:
        size[s] += len(WORD.findall(t or ""))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = sum(size.values()), set()
    while True:
        rest = total - sum(3 * size[s] for s in full)
        w = sum(weight[s] for s in order if s not in full)
        over = {s for s in order if s not in full and 3 * size[s] <= rest / w * weight[s]} if w else set()
        if not over:
            break
        full |= over
    return {s: 3 * size[s] if s in full else rest / w * weight[s] for s in order}, size


def test_mix(spark):
    rows = corpus()
    df = frame(spark, rows)
    got = M.mix(df).collect()
    target, size = wanted_targets(rows)
    assert len(got) == len(rows)
    by_id = {i: (len(WORD.findall(t or "")), s) for i, t, s in rows}
    taken, seen = defaultdict(int), defaultdict(list)
    for r in got:
        n, s = by_id[r.doc_id]
        assert (r.size, r.source_size) == (n, size[s])
        assert r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size + r.part_words
        taken[s] += r.taken
        seen[s].append(r)
    for s, t in target.items():
        assert abs(taken[s] - t) <= 3, s  # the threshold documents take the rest as a part of a copy
        # the rates meet the token constraint and are one exponential tilt
        assert sum(r.rate * r.size for r in seen[s]) == pytest.approx(t, rel=1e-6, abs=1e-3)
        mean = sum(r.size ** 2 for r in seen[s]) / max(1, size[s])
        lam = {round(math.log(r.rate) / r.size * mean, 6) for r in seen[s] if r.size and r.rate < 3 - 1e-9 and r.rate > 1e-300}
        assert len(lam) <= 1 or max(lam) - min(lam) < 1e-4, (s, lam)
    again = M.mix(df.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_copies_are_whole_documents(spark):
    rows = corpus()
    out = M.copies(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "source", "size", "target"]
    got = Counter((r.doc_id, r.text, r.source) for r in out.collect())
    assert set(got) <= set(rows) and max(got.values()) <= 6  # three, for a row that is there twice
    mixed = M.mix(frame(spark, rows)).collect()
    assert sum(got.values()) == sum(r.copies + (r.size > 0 and r.part_words * 2 >= r.size) for r in mixed)


def test_empty(spark):
    df = frame(spark, corpus()).limit(0)
    assert M.mix(df).count() == 0 and M.copies(df).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in M.mix(blank).collect()] == [(0, 0.0, 0)] * 2
