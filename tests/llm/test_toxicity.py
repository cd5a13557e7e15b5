"""The string-kernel machine: kernel against its definition, learning on made sentences, held-out accuracy."""

import zlib
from itertools import combinations

import duckdb
import numpy as np
import pytest

from commerce_lake.llm import toxicity as T


def slow_kernel(u, v):
    def triples(w):
        w = f"^{w}$"
        out = {}
        for a, b, c in combinations(range(len(w)), 3):
            if c - a < T.SPAN:
                out[w[a] + w[b] + w[c]] = out.get(w[a] + w[b] + w[c], 0) + T.DECAY ** (c - a + 1)
        return out

    a, b = triples(u), triples(v)
    dot = lambda x, y: sum(w * y.get(k, 0) for k, w in x.items())
    return dot(a, b) / np.sqrt(dot(a, a) * dot(b, b))


@pytest.mark.parametrize("u,v", [("scum", "scum"), ("scum", "sxcxum"), ("banana", "bananas"), ("abc", "xyz"), ("aa", "aaa")])
def test_kernel_is_the_gap_weighted_one(u, v):
    t = T.Triples("abcdefghijklmnopqrstuvwxyz")
    k, w = t.of([u, v])
    n = t.norms(k, w)
    table = {}
    for key, weight in zip(k[0], w[0]):
        if key >= 0:
            table[key] = table.get(key, 0) + weight
    got = sum(table.get(key, 0) * weight for key, weight in zip(k[1], w[1]) if key >= 0) / n[0] / n[1]
    assert got == pytest.approx(slow_kernel(u, v), abs=1e-9)


def test_units_cover_whole_tokens():
    assert T.units("i.d-i_o*t!") == ["i.d-i_o*t", "idiot"]
    long = "x" * 50 + "needle" + "y" * 50
    assert "needle" in "".join(T.units(long)) and any("needle" in p for p in T.units(long))
    assert "idiot" in T.tokens("you i d i o t there")


def sentences(n=300):
    rng = np.random.default_rng(0)
    plain = ["house", "garden", "river", "simple", "window", "letter", "kitchen", "summer", "paper", "stone", "cloud", "ideal", "scout"]
    bad = ["idiot", "scumbag", "moron"]
    rows = []
    for i in range(n):
        w = list(rng.choice(plain, 12))
        y = int(i % 4 == 0)
        if y:
            w[int(rng.integers(12))] = bad[i // 4 % 3]
        rows.append((" ".join(w), y))
    return rows


def test_learns_words_and_tolerates_inserted_characters():
    m = T.fit(sentences())
    good, bad = "the garden by the river", "the garden by the idiot"
    assert m.scores([good])[0] < 0.3 < 0.7 <= m.scores([bad])[0]
    for s in ("id.i.o.t", "i d i o t", "IDIOT!!", "idiiot", "mooron", "scum-bag", "i*d*i*o*t"):
        assert m.scores([f"the garden by the {s} now"])[0] > 0.5, s
    assert m.scores([None])[0] == m.scores([""])[0] < 0.3
    long = "garden " * 50_000
    assert m.scores([long])[0] < 0.3 and m.scores([long + "idiot"])[0] >= 0.7


def test_one_class_or_none():
    assert T.fit([]).scores(["x"]) == [0.0]
    assert T.fit([("a b", 1)]).scores(["x", None]) == [1.0, 1.0]


def test_frames(spark):
    rows = sentences(120)
    docs = spark.createDataFrame([(i, t, 1.5, "z") for i, (t, _) in enumerate(rows)] + [(None, None, 0.0, None), (3, "", 0.0, "q"), (7, "idiot", 1.0, "r")],
                                 "doc_id long, text string, score double, predicted string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)] + [(None, 1), (500, None), (0, 1)], "doc_id long, toxic int")
    m = T.train(docs, labels)
    got = T.score(docs, m).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    kept = T.drop_toxic(docs, m)
    assert kept.columns == docs.columns
    n = sum(r.predicted for r in got)
    assert 0 < n and kept.count() == len(got) - n
    assert T.score(docs.limit(0), m).count() == 0
    assert T.train(docs.limit(0), labels).scores(["x"]) == [0.0]


def test_held_out_accuracy():
    base = "/root/testdata/sf0.1"
    rows = duckdb.sql(f"select doc_id, text, toxic from '{base}/documents.parquet' join '{base}/labels.parquet' using (doc_id) order by doc_id").fetchall()
    fold = lambda i: zlib.crc32(str(i).encode()) % 3
    m = T.fit([(t, y) for i, t, y in rows if fold(i) != 1])
    test = [(t, y) for i, t, y in rows if fold(i) == 1]
    p = np.array(m.scores([t for t, _ in test])) >= 0.7
    y = np.array([y for _, y in test]) == 1
    assert (p == y).mean() > 0.95 and (p & y).sum() / y.sum() > 0.8 and (p & ~y).sum() / (~y).sum() < 0.03


def test_held_out_accuracy_of_train(spark, monkeypatch):
    """train() with its production bounds, on more labels of both classes than they take."""
    rows = sentences(8000)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    taken, fit = [], T.fit_bags
    monkeypatch.setattr(T, "fit_bags", lambda bags, y: taken.extend(y.tolist()) or fit(bags, y))
    m = T.train(docs, labels, lambda i: T.remainder(i, 10) != 1)
    assert taken.count(0) == T.PER_CLASS[0] and taken.count(1) == T.PER_CLASS[1]
    test = [(t, y) for i, (t, y) in enumerate(rows) if zlib.crc32(str(i).encode()) % 10 == 1]
    p = np.array(m.scores([t for t, _ in test])) >= T.THRESHOLD
    y = np.array([y for _, y in test]) == 1
    assert len(test) > 500 and (p == y).mean() > 0.95 and (p & y).sum() / y.sum() > 0.8 and (p & ~y).sum() / (~y).sum() < 0.03


def test_words_taken_on_executors_are_those_of_the_texts(spark):
    rows = [(3, "The garden, idiot"), (1, "b  a"), (1, "b  a"), (2, None), (4, "x" * 60_000), (None, "lost")]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, y string")
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 1), (None, 1)], "doc_id long, toxic int")
    bags, y = T.labelled_bags(docs, labels, lambda i: i.isNotNull(), T.PER_CLASS)
    assert bags.to_pylist() == [T.units_of("b  a"), [], T.units_of("The garden, idiot")] and y.tolist() == [0, 0, 1]
