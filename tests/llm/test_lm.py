"""The automaton against direct backoff recursion, and exact counts and base scores."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from commerce_lake.llm import lm as L


def words(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace(
        "\n", " ").replace("\r", " ").split(" ") if t else []


def corpus():
    rng = np.random.default_rng(6)
    vocab = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(vocab, int(rng.integers(0, 30)), p=np.arange(40, 0, -1) / 820))) for i in range(300)]
    rows += [(400 + i, "The same Phrase again and again\n" + f"rare{i}") for i in range(60)]
    rows += [(500, None), (501, ""), (502, " \t\x0b"), (None, "no id w1 w2"), (7, rows[7][1]), (503, "never éÉ seen\x85before"), (504, "w1 " * 20000)]
    return rows


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def slow(rows, prior=L.PRIOR):
    """score of each text by the recursion P(w | h) = (n(h w) + K P(w | shorter h)) / (n(h) + K)."""
    docs = [([w for w in words(t) if w], i) for i, t in rows]
    train = [w + [""] for w, i in docs if not held(i)]
    c1 = Counter(w for d in train for w in d)
    n, v = sum(c1.values()), len(c1)
    c2 = Counter(p for d in train for p in zip(["<s>"] + d, d))
    c3 = Counter(p for d in train for p in zip(["<s>"] + d, d, d[1:]))
    ctx = Counter(a for d in train for a in ["<s>"] + d[:-1])
    base = lambda w: (c1[w] + 0.5) / (n + 0.5 * (v + 1))

    def p2(a, b):
        return (c2[a, b] + prior[0] * base(b)) / (ctx[a] + prior[0])

    def p3(a, b, c):
        return (c3[a, b, c] + prior[1] * p2(b, c)) / (c2[a, b] + prior[1])

    out = []
    for w, i in docs:
        s = ["<s>"] + w + [""]
        b = sum(math.log10(base(x)) for x in s[1:])
        full = math.log10(p2("<s>", s[1])) + sum(math.log10(p3(*s[j - 2:j + 1])) for j in range(2, len(s)))
        out.append((i, held(i), len(s) - 1, sum(c1[x] > 0 for x in s[1:]), n, b, full))
    return out


@pytest.mark.parametrize("chunk_tokens", [L.CHUNK_TOKENS, 700])
def test_equals_direct_recursion(spark, chunk_tokens):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, chunk int, range string")
    got = sorted((tuple(r) for r in L.score(df, chunk_tokens=chunk_tokens).collect()), key=lambda r: (r[0] is None, r[0]))
    want = sorted(slow(rows), key=lambda r: (r[0] is None, r[0]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9, abs=1e-9), (g, w)
    assert any(abs(g[6] - g[5]) > 1 for g in got)


def automaton(rows, prior=L.PRIOR):
    w = L.Words(pa.array([t for _, t in rows], pa.string()))
    g = L.Grams(w)
    keys, counts = L.gram_counts(w, np.array([not held(i) for i, _ in rows]), 64)
    assert (keys == g.keys).all()
    words = g.totals(counts)[0]
    n, v = int(words.sum() - words[w.begin]), int((words > 0).sum()) - bool(words[w.begin])
    return w, g, L.Automaton(g, counts, n, v, prior), n, v


def step(w, g, a, state, word):
    """From one state, by any words: the arcs found by search."""
    word = np.asarray(word)
    two = g.pairs[state] if 0 <= state < len(g.pairs) else None
    b = two % g.v if two is not None else state - len(g.pairs)
    index = lambda keys, k: np.array([np.flatnonzero(keys == x)[0] if (keys == x).any() else -1 for x in k])
    pair = index(g.pairs, b * g.v + word) if b >= 0 else np.full(len(word), -1)
    triple = index(g.triples, state * g.v + word) if two is not None else np.full(len(word), -1)
    return a.step(np.full(len(word), state), word, pair, triple)


def test_states_arcs_and_failures():
    """A hand-made corpus: the state after each word is the longest context seen in training."""
    learned = [i for i in range(99) if not held(i)]
    rows = [(learned[0], "a b c"), (learned[1], "a b d"), (next(i for i in range(99) if held(i)), "a b zz c a")]
    w, g, a, _, _ = automaton(rows)
    number = {x: i for i, x in enumerate(w.words)}
    pair = {(w.words[p // g.v], w.words[p % g.v]): i for i, p in enumerate(g.pairs.tolist())}
    state, states = int(a.after_word[w.begin]), []
    for x in (b"a", b"b", b"zz", b"c", b"a", b""):
        state = int(step(w, g, a, state, [number[x]])[0][0])
        states.append(state)
    one = lambda x: len(g.pairs) + number[x]
    assert states == [pair[b" ", b"a"], pair[b"a", b"b"], -1, one(b"c"), one(b"a"), one(b"")]


def test_probabilities_of_a_context_add_up_to_one():
    rows = [(i, t) for i, t in corpus() if i is not None and not held(i)][:200]
    w, g, a, n, v = automaton(rows)
    every = np.array([i for i in range(g.v) if i != w.begin])
    for state in [-1, *range(0, len(g.pairs), 97), *(len(g.pairs) + np.arange(0, g.v, 7))]:
        if not -1 <= state < len(g.pairs) or w.end != g.pairs[state] % g.v:
            _, weight = step(w, g, a, int(state), every)
            left = 0.5 / (n + 0.5 * (v + 1))  # of an unknown word
            path = 1.0
            if 0 <= state < len(g.pairs):
                path, state = 10 ** a.pair_fails[state], len(g.pairs) + a.last[state]
            if state >= 0:
                path *= 10 ** a.word_fails[state - len(g.pairs)]
            assert (10 ** weight).sum() + path * left == pytest.approx(1)


def test_empty_and_untrained(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert L.score(df.limit(0)).count() == 0
    only = next(i for i in range(100) if held(i))
    r = L.score(spark.createDataFrame([(only, "a b")], "doc_id long, text string")).collect()[0]
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 3, 0, 0, 0.0, 0.0)


def test_every_ngram_counts_however_much_other_text_there_is(spark):
    """Single n-grams keep their arcs when 125,000 other tokens come: the score changes by the larger N and V alone."""
    some, turned = [i for i in range(10_000, 10_100) if held(i)][:2]
    few = [(10 * i, f"x{i} y{i}") for i in range(50)] + [(some, "x0 y0"), (turned, "y0 x0")]
    assert not held(0)
    other = [(1000 + i, " ".join(f"u{i}v{k}" for k in range(500))) for i in range(250)]
    for rows in (few, few + other):
        got = {r.doc_id: r for r in L.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        want = {w[0]: w for w in slow(rows)}
        assert got[some].score == pytest.approx(want[some][6]) and got[turned].score == pytest.approx(want[turned][6])
        assert got[some].base_score == pytest.approx(got[turned].base_score) and got[some].score > got[turned].score + 0.1


def test_held_out_texts_gain(spark):
    base = "/root/testdata/sf0.01"
    rows = L.score(spark.read.parquet(f"{base}/documents.parquet")).where("held_out").agg(
        F.sum("base_score"), F.sum("score")).first()
    print("held-out log10, base and model", rows)
    assert rows[1] > 0.94 * rows[0]
