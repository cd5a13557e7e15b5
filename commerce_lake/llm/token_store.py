"""Token ids in ORC: run-length encoded integers, row indexes, Bloom filters on ids.

``write`` encodes whole texts and stores one row per document in ascending
doc_id order: doc_id, n_tokens, offset (ids before it in its file part), part
and ids.  The documents are range-partitioned by id before they are encoded, so
each task writes one sorted ORC file whose stripes can be read by different
tasks; stripe and row-group statistics plus the Bloom filter let a look-up by
doc_id skip almost all of them.  ``read`` returns the rows with their global
start: the sums of the parts (one row a part) precede the offset inside a part.

Encoding goes through the tokenizer's own model.  Texts are cut into its pieces
(``token_counts.Splitter``); each distinct piece is encoded once per worker and
kept in a bounded cache.  A text that holds the string of an added special token
is encoded by the library as a whole.

Defined cases: a null text is an empty one and has the end id alone; a null
doc_id comes last; rows that share a doc_id are ordered by a hash of their
text, and equal rows are interchangeable; a very long text is one row; an empty
table gives an empty folder; further columns are ignored.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import token_counts

END_ID = 1
CACHE_PIECES = 1_000_000
SLICE_BYTES = 4 << 20
#: Writer options of the store (fixed values): stripes, rows per index entry, Bloom filter.
ORC_OPTIONS = {
    "orc.stripe.size": str(64 << 20),
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.encoding.strategy": "COMPRESSION",
    "compression": "zstd",
}
SCHEMA = "doc_id long, part int, offset long, n_tokens long, ids array<int>"
_encoders: dict[str, "Encoder"] = {}


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """encode(texts) by distinct pieces: all ids in a row, and the number of ids of each text.

    The ids of the pieces met so far lie one after another in ``flat``; piece k
    has ``size[k]`` of them from ``start[k]`` on.  Piece 0 is the end of a text.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.splitter = token_counts.Splitter(f.read())
        self.model = self.splitter.library.model
        self.spelled = {byte: name for name, byte in token_counts.byte_names().items()}
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.flat = np.array([END_ID], dtype=np.int32)
        self.start, self.size = np.zeros(1, dtype=np.int64), np.ones(1, dtype=np.int64)

    def learn(self, pieces: list[bytes]) -> None:
        tokenize, spelled = self.model.tokenize, self.spelled
        made = [[t.id for t in tokenize(p.decode("latin-1").translate(spelled))] for p in pieces]
        self.number.update(zip(pieces, range(len(self.size), len(self.size) + len(pieces))))
        self.flat = np.concatenate([self.flat, np.fromiter(itertools.chain.from_iterable(made), dtype=np.int32)])
        self.size = np.concatenate([self.size, np.fromiter(map(len, made), dtype=np.int64, count=len(made))])
        self.start = np.cumsum(self.size) - self.size

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.number) > CACHE_PIECES:
            self.clear()
        s = self.splitter
        texts = [t or "" for t in texts.to_pylist()]
        whole = [k for k, t in enumerate(texts) if s.special and "<" in t and s.special.search(t)]
        plain = [s.plain(t) for t in texts]
        for k in whole:
            plain[k] = b""
        found, upto = s.pieces(plain)
        coded = found.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if new := [p for p in distinct if p not in self.number]:
            self.learn(new)
        numbers = np.fromiter(map(self.number.__getitem__, distinct), dtype=np.int64, count=len(distinct))
        k = np.insert(numbers[np.asarray(coded.indices)], upto, 0)
        sizes = self.size[k]
        after = np.cumsum(sizes)
        # places in ``flat``: one step on inside a piece, a jump where the next piece begins
        step = np.ones(after[-1], dtype=np.int32)
        step[0], step[after[:-1]] = self.start[k[0]], self.start[k[1:]] - self.start[k[:-1]] - sizes[:-1] + 1
        ids = self.flat[np.cumsum(step, dtype=np.int32)]
        n = np.diff(after[upto + np.arange(len(upto))], prepend=0)
        if whole:
            parts = np.split(ids, np.cumsum(n)[:-1])
            for k in whole:
                own = s.library.encode(texts[k], add_special_tokens=False).ids
                parts[k] = np.array([*own, END_ID], dtype=np.int32)
            ids, n = np.concatenate(parts), np.array([len(p) for p in parts], dtype=np.int64)
        return ids, n


def encoder(path: str) -> Encoder:
    """One per worker process."""
    if path not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = Encoder(path)
    return _encoders[path]


def slices(batch: pa.RecordBatch):
    """The rows in pieces of about ``SLICE_BYTES`` of text, one row at least."""
    ends = np.cumsum(np.asarray(pc.binary_length(batch.column(1)), dtype=np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def write(docs: DataFrame, path: str, vocabulary_path: str, partitions: int | None = None) -> None:
    """Stores the token ids of all rows under ``path``."""

    def run(batches):
        e, part, offset = encoder(vocabulary_path), TaskContext.get().partitionId(), 0
        for b in batches:
            for rows in slices(b):
                ids, n = e.encode(rows.column(1).cast(pa.string()))
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(offset + ends - n), pa.array(n),
                     pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(ids))],
                    ["doc_id", "part", "offset", "n_tokens", "ids"])
                offset += int(ends[-1])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = slim.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged.mapInArrow(run, SCHEMA).write.options(**ORC_OPTIONS).orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids of every stored document."""
    rows = spark.read.schema(SCHEMA).orc(path)
    # one row per part (file), so this ordered sum is bounded by the number of files
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = totals.select("part", before.alias("before"))
    return rows.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The stored rows of a few documents: the predicate reaches the ORC reader, which prunes by metadata."""
    return spark.read.schema(SCHEMA).orc(path).where(F.col("doc_id").isin([int(i) for i in doc_ids])).select("doc_id", "n_tokens", "ids")


def checksums(stored: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian unsigned 32-bit integers."""

    def run(batches):
        for b in batches:
            ids = b.column(3)
            at = np.asarray(ids.offsets)
            flat = np.ascontiguousarray(np.asarray(ids.values), dtype="<i4")
            crc = [zlib.crc32(flat[lo:hi]) for lo, hi in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(crc, pa.int64())],
                                             ["doc_id", "start", "n_tokens", "ids_crc32"])

    return stored.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")
