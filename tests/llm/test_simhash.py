"""SimHash classes against all pairs of an independent fingerprint."""

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from commerce_lake.llm import simhash as S


def slow_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(rows, fp):
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 3:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            g = root(i)
            groups[g] = min(groups.get(g, r[0]), r[0])
    return [groups.get(root(i)) for i in range(len(rows))]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abC \t\n\x0b\x0c\r é İ", max_size=60))
def test_fingerprint(text):
    assert S.fingerprint(text.encode()) == slow_fingerprint(text)


def test_null_is_zero():
    assert S.fingerprint(None) == 0


def corpus():
    rng = np.random.default_rng(3)
    vocab = [f"v{i}" for i in range(300)]
    rows = []
    for i in range(60):
        w = list(rng.choice(vocab, 120))
        rows.append((i * 10, " ".join(w)))
        for j in range(int(rng.integers(0, 4))):  # near copies
            c = list(w)
            c[int(rng.integers(0, 120))] = "changed"
            rows.append((i * 10 + j + 1, " ".join(c)))
    rows += [(900, ""), (901, None), (902, " \n"), (903, "two words"), (904, "TWO words"), (905, rows[0][1]), (905, rows[0][1]),
             (905, "same id another text entirely"), (None, rows[3][1]), (None, "nameless and alone here"), (906, "x " * 40000)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 7, "c") for i, t in rows], "doc_id long, text string, fp int, component_id string")


def test_groups_equal_brute_force(spark):
    rows = corpus()
    fp = [slow_fingerprint(t) for _, t in rows]
    want = sorted([(r[0], f"{f:016x}", c) for r, f, c in zip(rows, fp, brute(rows, fp))], key=repr)
    got = S.group(frame(spark, rows)).collect()
    assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got], key=repr) == want
    assert any(c != d for d, _, c in want)


def test_keep_one_of_each_class(spark):
    rows = corpus()
    fp = [slow_fingerprint(t) for _, t in rows]
    comp = brute(rows, fp)
    df = frame(spark, rows)
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    ids = sorted([r.doc_id for r in kept.collect()], key=repr)
    assert ids == sorted({c for c in comp if c is not None} | ({None} if None in comp else set()), key=repr)
    got = {(r.doc_id, r.text) for r in kept.collect()}
    assert got <= set(rows)


def test_links_are_exact_on_random_close_fingerprints(spark):
    rng = np.random.default_rng(5)
    base = [int(x) for x in rng.integers(0, 1 << 63, 300)]
    fps = set(base)
    for x in base:
        for k in range(1, 5):
            y = x
            for b in rng.choice(64, k, replace=False):
                y ^= 1 << int(b)
            fps.add(y)
    fps = sorted(S._signed(x) for x in fps)
    want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    got = {(r.a, r.b) for r in S.links(S.distance_table(spark.createDataFrame([(x,) for x in fps], "fp long"))).collect()}
    assert got == want


def test_the_table_holds_the_distances_and_the_discard_is_their_largest_difference(spark):
    rng = np.random.default_rng(6)
    fps = [int(x) for x in rng.integers(0, 1 << 64, 200, dtype=np.uint64)] + [0, (1 << 64) - 1]
    df = S.distance_table(spark.createDataFrame([(S._signed(x),) for x in fps], "fp long"))
    rows = {r.fp: r.t for r in df.collect()}
    unpack = lambda t: [t[i // 7] >> 8 * (i % 7) & 255 for i in range(S.PIVOTS)]
    for x in fps:
        assert unpack(rows[S._signed(x)]) == [(x ^ p).bit_count() for p in S.full_pivots()]
    words = [tuple(int(d) for d in rng.integers(0, 65, 14)) for _ in range(300)]
    words += [(0,) * 7 + (64,) * 7, (64,) * 7 + (0,) * 7, (3, 0, 5, 60, 64, 9, 9) + (0, 3, 2, 63, 61, 9, 9), (4,) + (0,) * 13, (0,) * 6 + (4,) + (0,) * 7]
    pack = lambda v: sum(d << 8 * i for i, d in enumerate(v))
    pairs = spark.createDataFrame([(i, pack(w[:7]), pack(w[7:])) for i, w in enumerate(words)], "i int, a long, b long")
    for most in (3, 40):
        got = {r.i: r.ok for r in pairs.select("i", S._coordinates_agree(F.col("a"), F.col("b"), most).alias("ok")).collect()}
        assert got == {i: max(abs(x - y) for x, y in zip(w[:7], w[7:])) <= most for i, w in enumerate(words)}


def test_the_discard_takes_most_pairs_and_no_link(spark):
    """Fingerprints that share half their bits meet; nearly all of them go by the table alone."""
    rng = np.random.default_rng(7)
    low = int(rng.integers(0, 1 << 32))
    fps = {low | int(x) << 32 for x in rng.integers(0, 1 << 32, 400)}
    fps |= {x ^ 1 << int(b) for x in list(fps)[:50] for b in rng.choice(64, 1)}
    r = S.pair_counts(S.distance_table(spark.createDataFrame([(S._signed(x),) for x in fps], "fp long"))).first()
    assert r.n_lost == 0 and r.n_linked > 0 and r.n_met > 50_000
    assert r.n_discarded > 0.98 * (r.n_met - r.n_linked)


def test_empty(spark):
    assert S.group(frame(spark, corpus()).limit(0)).count() == 0
    assert S.keep_one(frame(spark, corpus()).limit(0)).count() == 0
