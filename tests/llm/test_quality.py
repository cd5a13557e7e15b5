"""Random-indexing vectors against their definition; held-out accuracy of the network."""

import zlib

import numpy as np

from commerce_lake.llm import quality as Q

TEXTS = ["The cat sat on the mat !!", "THE CAT SAT!! the the the", None, "", "1 2 3 ### x", "The cat sat on the mat !!", "é " * 3000]


def slow_vectors(texts):
    index = Q.index_vectors().astype(float)
    out = np.zeros((Q.BUCKETS, Q.DIM))
    for t in texts:
        c = Q.codes(t)
        x = [index[v // Q.SHAPES] + index[Q.BUCKETS + v % Q.SHAPES] + (index[-1] if i and c[i - 1] == v else 0) for i, v in enumerate(c)]
        for i, v in enumerate(c):
            for j in range(max(0, i - Q.REACH), min(len(c), i + Q.REACH + 1)):
                if j != i:
                    out[v // Q.SHAPES] += x[j]
    return out


def frame(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, 1, "s") for i, t in enumerate(texts)], "doc_id long, text string, bucket int, score string")


def test_word_vectors(spark, monkeypatch):
    assert np.array_equal(Q.word_vectors(frame(spark)), slow_vectors(TEXTS))
    assert not Q.word_vectors(frame(spark).limit(0)).any()


def test_long_texts_in_pieces_change_nothing(monkeypatch):
    p = Q.Pooler(slow_vectors(TEXTS))
    whole = [p.features(t) for t in TEXTS]
    monkeypatch.setattr(Q, "CHUNK", 7)
    assert all(np.allclose(a, p.features(t)) for a, t in zip(whole, TEXTS))


def test_scores_of_edge_cases(spark):
    model = Q.fit([("good words here", 1), ("### $$$ !!", 0)] * 20, slow_vectors(TEXTS))
    rows = Q.score(frame(spark), model).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert len({r.score for r in rows if TEXTS[r.doc_id] in (None, "")}) == 1
    assert Q.score(frame(spark).limit(0), model).count() == 0
    assert list(Q.fit([], slow_vectors([])).scores(["x", None])) == [0.0, 0.0]
    assert list(Q.fit([("x", 1)], slow_vectors([])).scores(["x"])) == [1.0]


def test_held_out_accuracy(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    model = Q.train(docs, labels)
    rows = docs.join(labels, "doc_id").select("doc_id", "text", "quality").collect()
    test = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    p = model.scores([r.text for r in test]) >= 0.3
    y = np.array([r.quality for r in test]) == 1
    print("accuracy", (p == y).mean(), "kept", (p & y).sum() / y.sum(), "junk caught", (~p & ~y).sum() / (~y).sum())
    assert (p == y).mean() > 0.9 and (p & y).sum() / y.sum() > 0.95 and (~p & ~y).sum() / (~y).sum() > 0.7
