"""Links and components of the pivot index against all pairs."""

import numpy as np
import pytest

from commerce_lake.llm import embedding_dedup as E


def brute(rows, cosine=0.93):
    n = len(rows)
    vec = [np.array(r[1], dtype=float) if r[1] and all(x is not None for x in r[1]) else None for r in rows]
    ok = [r[2] is not None and v is not None and np.isfinite(v).all() and (v != 0).any() for r, v in zip(rows, vec)]
    near = [[] for _ in rows]
    for i in range(n):
        for j in range(n):
            if i != j and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(vec[i]) == len(vec[j]):
                if vec[i] @ vec[j] / np.linalg.norm(vec[i]) / np.linalg.norm(vec[j]) >= cosine:
                    near[i].append(j)
    seen, comp = {}, []
    for i in range(n):
        reach, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in reach:
                    reach.add(j)
                    todo.append(j)
        comp.append(min((rows[j][0] for j in reach if rows[j][0] is not None), default=None))
    return sorted([(r[0], len(near[i]), comp[i], r[0] == comp[i]) for i, r in enumerate(rows)], key=repr)


def corpus(n=120, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.normal(size=dim)
        label = int(rng.integers(0, 3))
        rows.append((i * 10, v.astype(np.float32).tolist(), label))
        for j in range(int(rng.integers(0, 3))):
            c = v + rng.normal(size=dim) * 0.08
            rows.append((i * 10 + j + 1, c.astype(np.float32).tolist(), label if rng.random() < 0.9 else 9))
    hot = rng.normal(size=dim)
    rows += [(5000 + i, (hot + rng.normal(size=dim) * 0.02).astype(np.float32).tolist(), 1) for i in range(90)]  # a large group
    one = rows[0][1]
    rows += [(7000, one, rows[0][2]), (7000, one, rows[0][2]), (7001, None, 1), (7002, [0.0] * dim, 1), (7003, [float("nan")] * dim, 1),
             (7004, [None] + one[1:], 1), (7005, one, None), (7006, [], 1), (7007, [float("inf")] + one[1:], 1), (None, one, rows[0][2]),
             (None, None, 2), (7008, [1.0, 2.0], 1), (7009, [2.0, 4.0], 1), (7010, [x * 1000 for x in one], rows[0][2])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<float>, label int, cid int")


@pytest.mark.parametrize("block", [2048, 16])
def test_equals_all_pairs(spark, block):
    rows = corpus()
    got = E.link(frame(spark, rows), block=block).collect()
    assert sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in got], key=repr) == brute(rows)


def test_recall_near_the_threshold(spark):
    """Pairs just above the threshold, the hardest to retrieve."""
    rng = np.random.default_rng(2)
    rows, dim = [], 64
    for i in range(1500):
        v = rng.normal(size=dim)
        rows.append((i, v.tolist(), 0))
    for i in range(150):
        v = np.array(rows[i][1])
        z = rng.normal(size=dim)
        z -= v * (z @ v) / (v @ v)
        c = 0.935
        w = c * v / np.linalg.norm(v) + np.sqrt(1 - c * c) * z / np.linalg.norm(z)
        rows.append((2000 + i, w.tolist(), 0))
    got = sum(r.n_links for r in E.link(frame(spark, rows)).collect()) / 2
    assert got >= 0.9 * 150


def test_pivots_are_thinned():
    rng = np.random.default_rng(4)
    v = rng.normal(size=8)
    many = [v + rng.normal(size=8) * 0.01 for _ in range(50)] + list(rng.normal(size=(20, 8)))
    p = E.choose_pivots(many)
    assert len(p) <= 21 and ((p @ p.T) - np.eye(len(p)) < E.THIN + 1e-6).all()


def test_empty(spark):
    assert E.link(frame(spark, corpus(5)).limit(0)).count() == 0


@pytest.mark.parametrize("pivots", [180, 8192])
def test_near_pairs_share_pivots(spark, pivots):
    """Pairs at the threshold, 16 dimensions, are retrieved at any number of pivots."""
    rng = np.random.default_rng(5)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    x = unit(rng.normal(size=(1000, 16)))
    z = rng.normal(size=x.shape)
    z = unit(z - (z * x).sum(1)[:, None] * x)
    rows = [(i, 0, 1, v.tolist()) for i, v in enumerate(np.concatenate([x, 0.93 * x + np.sqrt(1 - 0.93 ** 2) * z]))]
    classes = spark.createDataFrame(rows, "cid long, label int, n long, embedding array<float>")
    p = unit(rng.normal(size=(pivots, 16))).astype(np.float32)
    perm = {r.cid: set(r.perm) for r in E._describe(classes, p, E.nearest_count(pivots)).collect()}
    assert sum(len(perm[i] & perm[1000 + i]) >= E.SHARED for i in range(1000)) >= 999
