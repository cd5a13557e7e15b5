"""SimHash near-duplicates found through pivot distance tables.

``fingerprints`` hashes every 3-word shingle of the whole text and keeps the
bits that more than half of the hashes set.  ``classes`` links distinct
fingerprints that differ in at most ``max_bits`` bits, exactly:

* The distance table is computed once per distinct fingerprint and stored: its
  Hamming distances to ``PIVOTS`` random reference fingerprints (pivots), seven
  of them packed in a long, and its join keys.
* Distances to a few full-width pivots can't be join keys: two random
  fingerprints agree within 3 in one of them about every second time.  So there
  are also pivots in one group per block of the 64 bits, random inside their
  block and zero outside.  Within a group, distances relative to the all-zero
  pivot change only if a bit of that block does; ``max_bits`` differing bits
  touch at most ``max_bits`` blocks, so two linked fingerprints have equal
  coordinates in at least ``blocks - max_bits`` groups: one key per choice of groups.
* A pair that met is discarded if any coordinate of the two stored rows differs
  by more than ``max_bits`` (triangle inequality: no link is lost), and the
  survivors are verified on the fingerprints.  ``pair_counts`` tells how many
  pairs met, were discarded and were linked.

Copies are one class before the join, so no pair inside a group of equal
fingerprints is ever formed.

Defined cases: a null, empty or blank text has fingerprint zero, which links as
any other; a text of fewer words than the shingle is hashed whole; a null
doc_id takes part, but a class is named by its smallest non-null id (null if it
has none); repeated rows are copies; empty tables give no rows; further columns
are ignored by ``group`` and kept by ``keep_one``.
"""

from __future__ import annotations

from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .names import free_prefix
from .scratch import Scratch

SHINGLE, MAX_BITS, BLOCKS, PIVOTS_PER_BLOCK, SEED = 3, 3, 6, 8, 42
PIVOTS, PACKED = 14, 7  # full-width pivots; distances (one byte each) in a long, which stays positive


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Bytes lower() and split() treat exactly A-Z and the six ASCII white-space bytes."""
    w = (text or b"").lower().split()
    if not w:
        return 0
    if len(w) <= shingle:
        grams = (b" ".join(w),)
        n = 1
    else:
        grams = map(b" ".join, zip(*(islice(w, i, None) for i in range(shingle))))
        n = len(w) - shingle + 1
    h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):  # a bounded bit matrix for a very long text
        part = h[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_key (a hash of the text) and fp (the 64 bits as a signed long) of every row."""

    def run(batches):
        for b in batches:
            texts = b.column(2).cast(pa.binary()).to_pylist()
            fp = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp, pa.int64())], ["doc_id", "text_key", "fp"])

    text = F.col("text").cast("string")
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
            .mapInArrow(run, "doc_id long, text_key long, fp long"))


def full_pivots(n: int = PIVOTS, seed: int = SEED) -> list[int]:
    """Random reference fingerprints of 64 bits."""
    return [int(x) for x in np.random.default_rng(seed).integers(0, 1 << 64, size=n, dtype=np.uint64)]


def pivots(blocks: int = BLOCKS, per_block: int = PIVOTS_PER_BLOCK, seed: int = SEED) -> list[list[int]]:
    """Per block of bits, ``per_block`` random reference fingerprints that are zero outside it."""
    edges = np.linspace(0, 64, blocks + 1).astype(int)
    rng = np.random.default_rng(seed)
    out = []
    for lo, hi in zip(edges, edges[1:]):
        bits = rng.integers(0, 2, size=(per_block, hi - lo))
        out.append([int(sum(int(b) << int(lo + i) for i, b in enumerate(row))) for row in bits])
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def distance_table(fps: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS,
                   per_block: int = PIVOTS_PER_BLOCK, full: int = PIVOTS) -> DataFrame:
    """fp, t (its distances to the full-width pivots, a byte each, PACKED in a long) and keys (one per choice of pivot groups)."""
    fp = F.col("fp")
    # coordinates relative to the zero pivot: unchanged while the block's bits are
    groups = [F.xxhash64(*[_hamming(fp, F.lit(_signed(p))) - F.bit_count(fp) for p in group]) for group in pivots(blocks, per_block)]
    table = fps.select("fp", *[g.alias(f"g{i}") for i, g in enumerate(groups)])
    keys = [F.xxhash64(F.lit(c), *[F.col(f"g{i}") for i in chosen])
            for c, chosen in enumerate(combinations(range(blocks), blocks - max_bits))]
    distances = [_hamming(fp, F.lit(_signed(p))).cast("long") for p in full_pivots(full)]
    packed = []
    for at in range(0, full, PACKED):
        word = F.lit(0).cast("long")
        for i, d in enumerate(distances[at:at + PACKED]):
            word = word.bitwiseOR(F.shiftleft(d, 8 * i))
        packed.append(word)
    return table.select("fp", F.array(*packed).alias("t"), F.array(*keys).alias("keys"))


def _coordinates_agree(a: Column, b: Column, max_bits: int) -> Column:
    """Whether no two bytes of the packed distances differ by more than ``max_bits``, all bytes at once:
    the top bit of 128 + x + max_bits - y stays set in a byte exactly if y - x <= max_bits."""
    top, most = (sum(v << 8 * i for i in range(PACKED)) for v in (128, max_bits))

    def not_below(x, y):
        return x.bitwiseOR(F.lit(top)) + F.lit(most) - y

    return not_below(a, b).bitwiseAND(not_below(b, a)).bitwiseAND(F.lit(top)) == F.lit(top)


def _met(table: DataFrame, max_bits: int, full: int = PIVOTS) -> DataFrame:
    """Pairs a < b that share a key (once per shared key), with ``near``: their table rows agree."""
    words = range(-(-full // PACKED))
    keyed = table.select("fp", *[F.col("t")[w].alias(f"t{w}") for w in words], F.posexplode("keys").alias("choice", "key"))

    def side(x):
        return keyed.select("choice", "key", F.col("fp").alias(x), *[F.col(f"t{w}").alias(f"{x}{w}") for w in words])

    near = F.lit(True)
    for w in words:
        near = near & _coordinates_agree(F.col(f"a{w}"), F.col(f"b{w}"), max_bits)
    return side("a").join(side("b"), ["choice", "key"]).where(F.col("a") < F.col("b")).select("a", "b", near.alias("near"))


def _linked(max_bits: int) -> Column:
    return _hamming(F.col("a"), F.col("b")) <= max_bits


def links(table: DataFrame, max_bits: int = MAX_BITS, full: int = PIVOTS) -> DataFrame:
    """All pairs a < b of the fingerprints of a distance table within ``max_bits`` bits."""
    return _met(table, max_bits, full).where(F.col("near")).where(_linked(max_bits)).select("a", "b").distinct()


def pair_counts(table: DataFrame, max_bits: int = MAX_BITS, full: int = PIVOTS) -> DataFrame:
    """One row: n_met (pairs that share a key, once per shared key), n_discarded (by their table rows),
    n_linked, and n_lost (links that the discard took: none)."""
    near, linked = F.col("near"), _linked(max_bits)
    return _met(table, max_bits, full).agg(
        F.count(F.lit(1)).alias("n_met"), F.count_if(~near).alias("n_discarded"),
        F.count_if(near & linked).alias("n_linked"), F.count_if(~near & linked).alias("n_lost"))


def classes(docs: DataFrame, scratch: Scratch, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """The fingerprint of every row (doc_id, text_key, fp), and per fingerprint (fp) the component
    (its smallest fingerprint) and the component_id (its smallest doc_id)."""
    fps = scratch.store(fingerprints(docs, shingle), "fingerprints")
    distinct = scratch.store(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    table = scratch.store(distance_table(distinct.select("fp"), max_bits), "table")
    found = scratch.store(connected_components(links(table, max_bits), scratch), "components")
    named = distinct.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return fps, named.join(least, "component").select("fp", "component", "component_id")


def group(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row."""
    scratch = Scratch(docs.sparkSession, "simhash")
    fps, cls = classes(docs, scratch, shingle, max_bits)
    cls = scratch.store(cls, "classes")
    return fps.join(cls, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each class, with all its columns: the row that names the class (a class
    without an id: any of its rows, by the hash of the text); of equal rows one."""
    scratch, p = Scratch(docs.sparkSession, "simhash"), free_prefix(docs)
    d, t = p + "d", p + "t"
    fps, cls = classes(docs, scratch, shingle, max_bits)
    kept = scratch.store(
        fps.join(cls, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("component", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("component", "doc_id").agg(F.min(F.struct("text_key", "n")).alias("one"))
        .select(F.col("doc_id").alias(d), "one.text_key", "one.n").withColumnRenamed("text_key", t), "kept")

    def rows(keys):
        return docs.join(keys, docs["doc_id"].eqNullSafe(F.col(d))
                         & F.xxhash64(docs["text"].cast("string")).eqNullSafe(F.col(t)), "left_semi")

    repeated = kept.where("n > 1").select(d, t)
    if not repeated.take(1):  # ids are unique: the usual case needs no second pass
        return rows(kept.select(d, t))
    return rows(kept.where("n = 1").select(d, t)).unionByName(rows(repeated).dropDuplicates(["doc_id", "text"]))
