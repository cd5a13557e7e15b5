"""Language-model scoring with a weighted backoff automaton.

The model: words are smoothed by adding 1/2; a pair's and a triple's probability
mix its count with the shorter context's probability, which weighs like
``PRIOR`` observations, (n(h w) + K P(w | h')) / (n(h) + K).  Every n-gram of
the training texts counts, a single one too, so what the model holds grows with
the text, and the probabilities of every context add up to one.

The automaton: a state is a context that training has seen (the last two words,
the last word, or nothing); an arc is an n-gram that training has seen, with its
log10 probability, and leads to the longest context that ends it; a failure arc
leads to the context one word shorter, with the log10 weight K / (n(h) + K).  A
text is read once from left to right: it holds a state, takes failure arcs until
the word has an arc, and adds the weights.

On Spark: the rows are dealt to chunks (by row number, so no text, source or id
makes one large).  A chunk asks for the training counts of its different n-grams
- sorted hashes, cut into ranges, each a packed difference list - which meet by
range; sums go back to the chunks in the same order, where they become
the part of the automaton that the chunk's texts can reach.  The texts are
shuffled once (both uses read the same exchange), an n-gram is sent once a chunk
however often it occurs, and no task holds more than a chunk or a range.  Nothing
is collected but three totals.

N-grams of equal hash count as one.  Hashes get two bits a doubling of the
tokens (``hash_bits``, 64 at most), so of a whole corpus's n-grams some dozens
collide, at any size up to 2^34 tokens.

Defined cases: a null or blank text has the end token alone; a null doc_id is
not held out; without training documents all counts are 0 and every token has
probability one; repeated rows are counted and scored each; a very long text is
in a chunk like any other; empty tables give no rows; further columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import remainder

HELD_OUT_MOD, HELD_OUT = 5, 1
#: Observations that the shorter context's probability is worth in a pair's and in a triple's context.
PRIOR = (3000.0, 5.0)
CHUNK_TOKENS = 1_000_000
BEGIN, END = b" ", b""  # no word is blank or empty
_M = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hashes of hashes."""
    x = a * np.uint64(_M[0]) + b
    x ^= x >> np.uint64(31)
    x *= np.uint64(_M[1])
    x ^= x >> np.uint64(29)
    x *= np.uint64(_M[2])
    return x ^ x >> np.uint64(32)


def hash_bits(tokens: int) -> int:
    return min(64, max(40, 2 * int(tokens).bit_length() - 4))


class Words:
    """The texts' words as numbers, a begin mark before and an end token after each text's."""

    def __init__(self, texts: pa.Array):
        split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
        coded = split.flatten().dictionary_encode()
        code = np.asarray(coded.indices, dtype=np.int64)
        doc = np.repeat(np.arange(len(split)), np.diff(np.asarray(split.offsets)))
        found = coded.dictionary.cast(pa.large_binary()).to_pylist()
        if END in found:  # around white space at a text's ends
            none = found.index(END)
            real = code != none
            code, doc = code[real], doc[real]
            code -= code > none
            del found[none]
        self.words = [*found, BEGIN, END]
        self.begin, self.end = len(found), len(found) + 1
        n = np.bincount(doc, minlength=len(split))
        self.first = np.cumsum(n + 2) - (n + 2)
        self.size = n + 1  # tokens: words and the end
        self.seq = np.full(int((n + 2).sum()), self.end, dtype=np.int64)
        self.seq[self.first] = self.begin
        self.seq[np.arange(len(code)) + 2 * doc + 1] = code
        self.doc = np.repeat(np.arange(len(n), dtype=np.int32), n + 2)
        self.hash = np.fromiter(map(xxhash.xxh64_intdigest, self.words), dtype=np.uint64, count=len(self.words))


def _counted(key: np.ndarray, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, sorted, and how often each is learned from."""
    k = np.sort(key << 1 | ~learned)
    first = np.flatnonzero(np.r_[True, k[1:] >> 1 != k[:-1] >> 1]) if len(k) else np.zeros(0, np.int64)
    return k[first] >> 1, np.add.reduceat(1 - (k & 1), first) if len(k) else np.zeros(0, np.int64)


def _keys(w: Words, pairs: np.ndarray, of_pair: np.ndarray, third: np.ndarray, bits: int) -> np.ndarray:
    """Hashes of the words, the pairs and the triples (the number of their pair, their last word)."""
    v = len(w.words)
    hashed = _mix(w.hash[pairs // v], w.hash[pairs % v])
    keys = [_mix(w.hash, np.full(v, 1, np.uint64)), hashed, _mix(hashed[of_pair], w.hash[third])]
    return np.concatenate(keys) >> np.uint64(64 - bits)


def gram_counts(w: Words, training: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of a chunk's different words, pairs and triples, and their counts in its training texts."""
    seq, v, learned = w.seq, len(w.words), training[w.doc]
    at = np.flatnonzero(seq[:-1] != w.end)
    key = seq[at] * v + seq[at + 1]
    pairs, n2 = _counted(key, learned[at])
    more = np.flatnonzero(seq[at + 1] != w.end)
    if v ** 3 < 1 << 61:
        triples, n3 = _counted(key[more] * v + seq[at[more] + 2], learned[at[more]])
        of_pair = np.searchsorted(pairs, triples // v)
    else:
        number = np.searchsorted(pairs, key[more])
        triples, n3 = _counted(number * v + seq[at[more] + 2], learned[at[more]])
        of_pair = triples // v
    keys = _keys(w, pairs, of_pair, triples % v, bits)
    order = np.argsort(keys)
    return keys[order], np.concatenate([np.bincount(seq[learned], minlength=v), n2, n3])[order]


class Grams:
    """The different words, pairs and triples of a chunk, and where each place of its texts has them (-1: none begins)."""

    def __init__(self, words: Words, bits: int = 64):
        w, seq, v = words, words.seq, len(words.words)
        self.v, self.of = v, words
        at = np.flatnonzero(seq[:-1] != w.end)  # a pair begins at each of these
        self.pairs, pair = np.unique(seq[at] * v + seq[at + 1], return_inverse=True)
        more = np.flatnonzero(seq[at + 1] != w.end)  # the next pair begins at the next place
        self.triples, place, triple = np.unique(pair[more] * v + seq[at[more] + 2], return_index=True, return_inverse=True)
        self.tail = pair[more[place] + 1]  # the pair that ends the triple
        self.pair_at, self.triple_at = (np.full(len(seq), -1, dtype=np.int32) for _ in range(2))
        self.pair_at[at], self.triple_at[at[more]] = pair, triple
        keys = _keys(w, self.pairs, self.triples // v, self.triples % v, bits)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def totals(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts in the order of the keys, as those of words, pairs and triples."""
        out = np.empty(len(counts), dtype=np.int64)
        out[self.order] = counts
        return np.split(out, [self.v, self.v + len(self.pairs)])


class Automaton:
    """States, arcs and failure arcs that a chunk's texts can reach, with log10 weights.

    A state is a pair's number, a word's number after those of the pairs, or -1.
    """

    def __init__(self, grams: Grams, counts: np.ndarray, n: int, v: int, prior: tuple[float, float] = PRIOR):
        self.g = g = grams
        words, pairs, triples = g.totals(counts)
        k2, k3 = prior
        self.known = words > 0
        p1 = (words + 0.5) / (n + 0.5 * (v + 1))
        a, b = g.pairs // g.v, g.pairs % g.v
        p2 = (pairs + k2 * p1[b]) / (words[a] + k2)
        head = g.triples // g.v
        p3 = (triples + k3 * p2[g.tail]) / (pairs[head] + k3)
        self.word_arc, self.pair_arc, self.triple_arc = np.log10(p1), np.log10(p2), np.log10(p3)
        self.pair_seen, self.triple_seen = pairs > 0, triples > 0
        self.word_fails, self.pair_fails = np.log10(k2 / (words + k2)), np.log10(k3 / (pairs + k3))
        first = len(g.pairs)
        self.last = b
        #: the longest known context after a word, and after a pair
        self.after_word = np.where(words > 0, first + np.arange(g.v), -1)
        self.after_pair = np.where(pairs > 0, np.arange(first), self.after_word[b])

    def compiled(self) -> tuple[np.ndarray, np.ndarray]:
        """For each place of the texts and each length of the state's context (0, 1, 2): weight, and the next length."""
        g, w = self.g, self.g.of
        pairs, none = len(g.pairs), np.full(1, -1, dtype=np.int32)
        pair = np.r_[none, g.pair_at[:-1]]  # that ends here
        before = np.r_[none, pair[:-1]]  # that ends one place before
        triple = np.r_[none, none, g.triple_at[:-2]]
        word = np.r_[w.end, w.seq[:-1]]
        weights, lengths = np.empty((3, len(w.seq))), np.empty((3, len(w.seq)), dtype=np.int8)
        for lo in range(0, len(word), 1 << 18):
            some = slice(lo, lo + (1 << 18))
            for k, state in enumerate((np.full(len(word[some]), -1), pairs + word[some], before[some])):
                to, weights[k, some] = self.step(state, w.seq[some], pair[some], triple[some])
                lengths[k, some] = np.where(to < 0, 0, np.where(to < pairs, 2, 1))
        return weights, lengths

    def walk(self) -> np.ndarray:
        """Log10 weight of every text: one pass over its words, all texts of the chunk side by side."""
        w = self.g.of
        weights, lengths = (x.ravel() for x in self.compiled())
        by = np.argsort(-w.size, kind="stable")
        at = w.first[by]
        ends = np.searchsorted(-w.size[by], -np.arange(1, (w.size.max() if len(by) else 0) + 1), side="right")
        total, state = np.zeros(len(by)), np.full(len(by), int(self.after_word[w.begin] >= 0))
        for place, live in enumerate(ends.tolist(), 1):  # the texts of at least ``place`` tokens
            arc = state[:live] * len(w.seq) + at[:live] + place
            total[:live] += weights[arc]
            state = lengths[arc].astype(np.int64)
        out = np.empty_like(total)
        out[by] = total
        return out

    def step(self, state: np.ndarray, word: np.ndarray, pair: np.ndarray, triple: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states, and the weights of the failure arcs and the arc taken.

        ``pair`` and ``triple`` number the arcs that read ``word`` from a
        one-word and a two-word state (-1: the chunk has no such arc).
        """
        g, pairs = self.g, len(self.g.pairs)
        deep = (state >= 0) & (state < pairs)
        three = deep & (triple >= 0)
        three[three] = self.triple_seen[triple[three]]
        weight, to = np.zeros(len(state)), np.full(len(state), -2, dtype=np.int64)
        weight[three] = self.triple_arc[triple[three]]
        to[three] = self.after_pair[g.tail[triple[three]]]
        fails = np.flatnonzero(deep & ~three)
        weight[fails] = self.pair_fails[state[fails]]
        word_state = np.where(deep, 0, state - pairs)
        word_state[fails] = self.last[state[fails]]
        one = np.flatnonzero(~three & (word_state >= 0))
        b, k = word_state[one], pair[one]
        hit = k >= 0
        hit[hit] = self.pair_seen[k[hit]]
        weight[one] += np.where(hit, self.pair_arc[k] if pairs else 0.0, self.word_fails[b])
        to[one[hit]] = self.after_pair[k[hit]]
        rest = np.flatnonzero(to == -2)
        weight[rest] += self.word_arc[word[rest]]
        to[rest] = self.after_word[word[rest]]
        return to, weight


_ZSTD = pa.Codec("zstd", compression_level=1)


def _packed(x: np.ndarray) -> bytes:
    """64-bit numbers, equal bytes side by side, compressed."""
    planes = np.ascontiguousarray(np.ascontiguousarray(x, dtype="<u8").view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(x).to_bytes(8, "little") + _ZSTD.compress(planes, asbytes=True)


def _unpacked(b: bytes) -> np.ndarray:
    planes = _ZSTD.decompress(b[8:], 8 * int.from_bytes(b[:8], "little"))
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _training(held: pa.ChunkedArray) -> np.ndarray:
    return ~np.asarray(held.to_numpy(zero_copy_only=False), dtype=bool)


def _column(table: pa.Table, name: str) -> pa.Array:
    out = table.column(name).combine_chunks()
    return pa.concat_arrays(out.chunks) if isinstance(out, pa.ChunkedArray) else out


def totals(slim: DataFrame) -> tuple[int, int, int]:
    """Training tokens N, different training tokens V, tokens of all texts."""

    def run(batches):
        for b in batches:
            w = Words(b.column(1))
            token = w.seq != w.begin
            learned = _training(b.column(0))[w.doc] & token
            c = np.bincount(w.seq[learned], minlength=len(w.words))
            met = np.flatnonzero(c)
            # the null word holds the number of all tokens
            yield pa.RecordBatch.from_arrays([pa.array([*w.hash[met].view(np.int64).tolist(), None], pa.int64()),
                                              pa.array(np.r_[c[met], token.sum()].astype(np.int64))], ["h", "c"])

    counts = slim.select("held_out", "text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    total = lambda on: F.coalesce(F.sum(F.when(on, F.col("c"))), F.lit(0))
    row = counts.agg(total(F.col("h").isNotNull()), F.count("h"), total(F.col("h").isNull())).first()
    return int(row[0]), int(row[1]), int(row[2])


ASKED = "chunk int, range int, keys binary, counts binary"


def _asked(table: pa.Table, ranges: int, bits: int) -> pa.Table:
    """What a chunk asks for: a row a range of keys, with its own training counts."""
    keys, counts = gram_counts(Words(_column(table, "text")), _training(table.column("held_out")), bits)
    width = (1 << bits) // ranges + 1
    at = np.searchsorted(keys, np.array([r * width for r in range(ranges)], dtype=np.uint64))
    rows = [(lo, hi, r) for r, (lo, hi) in enumerate(zip(at.tolist(), [*at.tolist()[1:], len(keys)])) if lo < hi]
    chunk = table.column("chunk")[0].as_py()
    return pa.table({
        "chunk": pa.array([chunk] * len(rows), pa.int32()), "range": pa.array([r for _, _, r in rows], pa.int32()),
        "keys": pa.array([_packed(np.diff(keys[lo:hi], prepend=np.uint64(r * width))) for lo, hi, r in rows], pa.binary()),
        "counts": pa.array([_packed(counts[lo:hi]) for lo, hi, _ in rows], pa.binary())})


def _answered(table: pa.Table) -> pa.Table:
    """The sums over all chunks, to each chunk in the order that it asked in (keys count from the range's first)."""
    keys = [np.cumsum(_unpacked(b), dtype=np.uint64) for b in table.column("keys").to_pylist()]
    counts = [_unpacked(b).astype(np.int64) for b in table.column("counts").to_pylist()]
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    new = np.r_[True, every[order][1:] != every[order][:-1]]
    sums = np.add.reduceat(np.concatenate(counts)[order], np.flatnonzero(new))
    out = np.empty(len(every), dtype=np.int64)
    out[order] = sums[np.cumsum(new) - 1]
    parts = np.split(out, np.cumsum([len(k) for k in keys])[:-1])
    return pa.table({"chunk": _column(table, "chunk"), "range": _column(table, "range"),
                     "counts": pa.array([_packed(p) for p in parts], pa.binary())})


def score(docs: DataFrame, mod: int = HELD_OUT_MOD, held: int = HELD_OUT, prior: tuple[float, float] = PRIOR,
          chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    out = F.coalesce(remainder(F.col("doc_id"), mod) == held, F.lit(False))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), out.alias("held_out"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n, v, tokens = totals(slim)
    chunks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-tokens // chunk_tokens))
    bits = hash_bits(tokens)
    dealt = slim.withColumn("chunk", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(chunks)).cast("int"))

    def ask(table):
        return _asked(table, chunks, bits)

    def scored(texts, answers):
        if not texts.num_rows:
            raise RuntimeError("counts came back for a chunk without texts")
        w = Words(_column(texts, "text"))
        g = Grams(w, bits)
        by = np.argsort(np.asarray(answers.column("range")), kind="stable")
        sums = [_unpacked(b) for b in answers.column("counts").take(pa.array(by)).to_pylist()]
        counts = np.concatenate(sums).astype(np.int64) if sums else np.zeros(0, np.int64)
        if len(counts) != len(g.keys):
            raise RuntimeError("a chunk's texts are not those that its n-grams were counted for")
        a = Automaton(g, counts, n, v, prior)
        token = w.seq != w.begin
        each = lambda x: np.bincount(w.doc[token], x, minlength=len(w.first))
        known, base = each(a.known[w.seq[token]]), each(a.word_arc[w.seq[token]])
        return pa.table({
            "doc_id": _column(texts, "doc_id"), "held_out": _column(texts, "held_out"), "n_tokens": pa.array(w.size, pa.int64()),
            "n_known": pa.array(known.astype(np.int64)), "train_tokens": pa.array(np.full(len(w.first), n, np.int64)),
            "base_score": pa.array(base), "score": pa.array(a.walk())})

    answers = dealt.groupBy("chunk").applyInArrow(ask, ASKED).groupBy("range").applyInArrow(_answered, "chunk int, range int, counts binary")
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        scored, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
