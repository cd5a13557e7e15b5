"""Counts against the tokenizer's library: odd strings, every character class, chunk borders, defined cases."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from commerce_lake.llm import token_counts as T
from commerce_lake.llm.queries import QUERIES
from commerce_lake.llm.token_store import vocabulary

BITS = ["'s", "'S", "'re", "'r", "'ve", "'v", "'ll", "'l", "'d", "'", "''", "!", "...", "a", "the", "Hello", "\xdf", "\xc9", "\xe9", "é", "́",
        "İ", "Σ", "ΑΣ", "日本", "１", "\xbd", "3", "42", " ", "\t", "\n", "\xa0", "　", " ", "\x1c", "\x85",
        "\x00", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<", "|", "antidisestablishment", "qzxj", "aaaa", "ing", "\U0001f600",
        "\U0001f469‍\U0001f467", "क्ष", "ﬁ", "K", "ſ", "ŉ", "ᾼ", "_", "-", "$", "١", "Ⅷ", "\xaa",
        "e", "r", "l", "s"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


@pytest.fixture(scope="module")
def counter():
    with open(vocabulary(), encoding="utf-8") as f:
        return T.Counter(f.read())


def expected(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def odd_texts():
    rng = random.Random(1)
    out = ["".join(rng.choice(BITS) for _ in range(rng.randrange(25))) for _ in range(3000)]
    out += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(32, 0x250), rng.randrange(0xA0, 0xD7FF), rng.randrange(0x10000, 0x20000)]))
                    for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    out += ["".join(rng.choice("abcdeist'") for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    return out + ["a" * 5000, "ab" * 3000, "'" * 999, ("x" * 100 + " ") * 100, "", " ", "　　"]


def test_counts_are_those_of_the_library(library, counter):
    texts = odd_texts()
    assert counter.count(texts).tolist() == expected(library, texts)


def test_parts_chunks_and_cleared_tables_change_nothing(library, counter, monkeypatch):
    texts = odd_texts()[::7] + [" ".join(odd_texts()[:500])]
    monkeypatch.setattr(T, "PART_BYTES", 50)
    monkeypatch.setattr(T, "MOST_STATES", 100)
    monkeypatch.setattr(T, "MOST_PIECES", 100)
    assert counter.count(texts).tolist() == expected(library, texts)


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 64])
def test_scan_of_state_maps_is_the_sequential_run(chunk):
    rng = np.random.default_rng(chunk)
    classes = rng.integers(0, T.CLASSES, 500).astype(np.uint8)
    state, want = T.FRESH, np.zeros(502, dtype=bool)
    for i, c in enumerate([*classes.tolist(), T.SPACE]):
        mark = T.MARKS[c, state]
        want[i] |= bool(mark & T.HERE)
        want[i - 1] |= bool(mark & T.BEFORE)
        state = T.NEXT[c, state]
    assert T.piece_starts(classes, chunk).tolist() == want[:500].tolist()


def test_emitted_counts_are_never_negative_and_add_up(library, counter):
    p = counter.counter
    for word in (b"antidisestablishmentarianism", b"aaaaaaaaaaaaa", "stra\xdfenbahn".encode()):
        k, total = 0, 0
        for byte in word[:-1]:
            k, sure = p.arcs[k].get(byte) or p._arc(k, byte)
            assert sure >= 0
            total += sure
        assert total + p._final(k, word[-1]) == len(library.encode(word.decode(), add_special_tokens=False).ids)


def test_other_files_are_refused():
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        T.Counter(f.read())


def test_query_over_the_whole_table(spark, library):
    base = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op11_token_counts"](spark, base).collect()}
    want = expected(library, [r.text for r in docs])
    assert len(got) == len(docs)
    assert got == {r.doc_id: (len((r.text or "").encode()), n, n > 2048) for r, n in zip(docs, want)}


def test_defined_cases(spark, library):
    rows = [(None, "a b", 1), (1, None, 2), (2, "", 3), (3, " \t ", 4), (4, "x y", 5), (4, "x y", 5), (5, "caf\xe9 <|endoftext|>!", 6),
            (6, "long 12 " * 100_000, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in T.count_tokens(df, vocabulary()).collect()))
    want = expected(library, [t for _, t, _ in rows])
    assert got == sorted((i or 0, len((t or "").encode()), n, n > 2048) for (i, t, _), n in zip(rows, want))
    assert T.count_tokens(df.limit(0), vocabulary()).count() == 0
