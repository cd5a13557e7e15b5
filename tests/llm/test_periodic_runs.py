"""Runs against plain enumeration, the query's digests against a plain rewrite, defined cases."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from commerce_lake.llm import periodic_runs as P
from commerce_lake.llm.queries import QUERIES


def slow_runs(w, least=6, times=4):
    codes = {}
    x, n, out = np.array([codes.setdefault(v, len(codes)) for v in w]), len(w), {}
    for q in range(1, n // times + 1):
        same = np.r_[False, x[q:] == x[:-q], False]
        first, last = np.flatnonzero(same[1:] & ~same[:-1]), np.flatnonzero(~same[1:] & same[:-1])
        for i, j in zip(first.tolist(), last.tolist()):
            if j + q - i >= max(least, times * q):
                out.setdefault((i, j + q - i), q)  # q grows: the first one is the smallest period
    return sorted((s, length, q) for (s, length), q in out.items())


def collapse(w, runs):
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    return [x for i, x in enumerate(w) if i not in gone]


def found(texts, times=4):
    codes = {}
    key = np.array([codes.setdefault((d, w), len(codes)) for d, t in enumerate(texts) for w in t], dtype=np.int64)
    n = np.array([len(t) for t in texts])
    doc, ends = np.repeat(np.arange(len(texts)), n), np.cumsum(n)
    start, length, period = P.runs_of(key, (ends - n)[doc], ends[doc], least_periods=times)
    out = [[] for _ in texts]
    for s, m, q in zip(start, length, period):
        out[doc[s]].append((int(s - (ends - n)[doc[s]]), int(m), int(q)))
    return out


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
@pytest.mark.parametrize("times", [2, 4])
def test_runs_are_those_of_plain_enumeration(letters, times):
    rng = random.Random(letters * 10 + times)
    texts = [[]]
    for _ in range(150):
        t = []
        while len(t) < rng.randrange(1, 70):
            unit = [rng.randrange(letters) for _ in range(rng.randrange(1, 6))]
            t += unit * rng.randrange(1, 9) + unit[:rng.randrange(len(unit) + 1)]
        texts.append(t)
    assert found(texts, times) == [slow_runs(t, times=times) for t in texts]


def test_long_runs_and_many_rotations():
    t = list(range(50)) * 400 + ["x"] + ["y"] * 20_000
    assert found([t, t[:7]]) == [[(0, 20_000, 50), (20_001, 20_000, 1)], []]


def rewritten(doc_id, text):
    w = [x for x in (text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if x]
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def expected(doc_id, text):
    w = rewritten(doc_id, text)
    runs = slow_runs(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(collapse(w, runs))))


def rows_of(df):
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted((tuple(r) for r in df.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                                               "collapsed_sha256").collect()), key=key), key


def test_query_against_plain_code(spark):
    base = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text").collect()
    got, key = rows_of(QUERIES["op12_periodic_runs"](spark, base))
    assert got == sorted((expected(r.doc_id, r.text) for r in docs), key=key)
    assert any(r[1] for r in got)


def test_defined_cases(spark, tmp_path):
    rows = [(None, "a b a b a b a b a b", 1), (1, None, 2), (2, "", 3), (3, " \t\n ", 4), (4, "x " * 9, 5), (4, "x " * 9, 5),
            (5, "  é é é é é é é end\x1c", 6), (6, "a b c " * 8_000 + "tail", 7)]
    rows += [(i, "one two three four five " * 5, 0) for i in range(100, 130)]
    spark.createDataFrame(rows, "doc_id long, text string, start long").write.parquet(f"{tmp_path}/documents.parquet")
    got, key = rows_of(QUERIES["op12_periodic_runs"](spark, str(tmp_path)))
    small = [expected(i, t) for i, t, _ in rows if i != 6]
    assert [r for r in got if r[0] != 6] == sorted(small, key=key)
    assert [r[1:6] for r in got if r[0] == 6] == [expected(6, rows[7][1])[1:6]]
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert P.find_runs(df.limit(0)).count() == 0
    one = P.find_runs(df.where("doc_id is null")).first()
    assert one.n_words == 10 and one.collapsed == "a b" and [tuple(r) for r in one.runs] == [(0, 10, 2)]
    with pytest.raises(ValueError):
        P.find_runs(df, least_periods=1)
