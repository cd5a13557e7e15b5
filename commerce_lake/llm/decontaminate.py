"""Benchmark decontamination: prefix-filtered set join of windows and documents.

Every benchmark item is cut into windows of ``window`` consecutive words (a
shorter item is one window).  A window is a set of shingles that a document has
to contain completely, so its necessary prefix in rarity order is one shingle:
the one that the corpus holds least often.  Documents are joined with those
prefix shingles only; the shingle's place in the window and the two lengths
bound where the window can lie, and an exact comparison of the words there
decides.  DataFrame functions only, no Python on the executors.

Defined cases: a null or word-less text has no words and no hits; a null or
word-less item has no windows; an item with a null id makes hits but is not
counted as an item; repeated rows (of documents or items) give repeated
documents the same result and repeated items one entry; empty tables give zero
hits or no rows; further columns are ignored by ``decontaminate`` and kept by
``drop_contaminated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .names import free_prefix
from .scratch import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, SHINGLE = 10, 3
#: A benchmark side of up to so many rows is broadcast (20 short words a row at
#: most, so under 100 MB); a larger one is joined by a shuffle of slim rows.
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    """A-Z lower-cased; the words of the whole text, in order."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, NOT_WORD), "")


def _shingle(w: str, at: str, k: int) -> Column:
    """Hash of the k words from 0-based place ``at``; a match is verified later."""
    return F.xxhash64(F.lit(k), *[F.get(F.col(w), F.col(at) + i) for i in range(k)])


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a text key, so that rows that share an id stay apart."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))


def _places(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """One row per document word: doc_id, text_key, w (all words), pos, h (its shingle)."""
    at = (docs.select("doc_id", "text_key", words(F.col("text")).alias("w"))
          .where(F.size("w") > 0)
          .select("doc_id", "text_key", "w", F.explode(F.sequence(F.lit(0), F.size("w") - 1)).alias("pos")))
    if len(lengths) == 1:
        return at.withColumn("h", _shingle("w", "pos", lengths[0]))
    return at.withColumn("h", F.explode(F.array(*[_shingle("w", "pos", k) for k in lengths])))


def _maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def find_windows(docs: DataFrame, items: DataFrame, scratch: Scratch, window: int = WINDOW,
                 shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """All occurrences (doc_id, text_key, start, n, window_id), and the items of each window
    (window_id, item_id).  ``docs`` has doc_id, text and text_key."""
    cut = (items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
           .select("item_id", "w", F.least(F.size("w"), F.lit(window)).alias("n"))
           .select("item_id", "n", F.explode(F.expr("transform(sequence(0, size(w) - n), i -> slice(w, i + 1, n))")).alias("ww"))
           .withColumn("window_id", F.md5(F.array_join("ww", " "))))
    item_windows = scratch.store(cut.select("window_id", "item_id").distinct(), "item_windows")
    windows = cut.select("window_id", "n", "ww").dropDuplicates(["window_id"])
    lengths = sorted(k for k in range(1, shingle + 1))
    held = windows.withColumn("k", F.least(F.col("n"), F.lit(shingle)))
    shingles = scratch.store(
        held.select("window_id", "n", "ww", "k", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("k"))).alias("p"))
        .withColumn("h", F.coalesce(*[F.when(F.col("k") == k, _shingle("ww", "p", k)) for k in lengths])), "shingles")
    lengths = sorted(r.k for r in shingles.select("k").distinct().collect())  # at most `shingle` values
    keys = shingles.select("h").distinct()
    n_keys = keys.count()
    # rarity over the whole corpus, of the shingles that some window has
    places = _places(docs, lengths or [shingle])
    counts = (places.select("h").join(_maybe_broadcast(keys, n_keys), "h")
              .groupBy("h").agg(F.count(F.lit(1)).alias("c")))
    # a shingle that no document holds rules its windows out, hence the inner join's left form:
    ranked = (shingles.join(counts, "h", "left")
              .groupBy("window_id").agg(F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "h", "p")).alias("least"),
                                        F.first("n").alias("n"), F.first("ww").alias("ww"))
              .where("least.c > 0"))
    prefixes = scratch.store(ranked.select("window_id", "n", "ww", "least.h", "least.p"), "prefixes")
    n_prefixes = prefixes.count()
    if n_prefixes <= BROADCAST_ROWS:
        met = places.join(F.broadcast(prefixes), "h")
    else:  # slim rows are shuffled, and only documents with a candidate meet their words again
        slim = places.select("doc_id", "text_key", "pos", "h").join(prefixes, "h")
        texts = docs.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"),
                            words(F.col("text")).alias("w")).dropDuplicates(["d", "t"])
        met = slim.join(texts, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("text_key").eqNullSafe(F.col("t")))
    start = F.col("pos") - F.col("p")
    hits = (met.where((start >= 0) & (start + F.col("n") <= F.size("w")))  # positional and length bounds
            .where(F.slice("w", start + 1, F.col("n")) == F.col("ww"))  # exact containment
            .select("doc_id", "text_key", start.alias("start"), "n", "window_id"))
    return hits, item_windows


COVERED = """aggregate(array_sort(spans), named_struct('hit', 0L, 'reach', 0),
    (acc, s) -> named_struct('hit', acc.hit + greatest(0, s.end - greatest(s.start, acc.reach)),
                             'reach', greatest(acc.reach, s.end)),
    acc -> acc.hit)"""


def _per_document(docs: DataFrame, items: DataFrame, scratch: Scratch, window: int, shingle: int) -> DataFrame:
    """doc_id, text_key, spans, n_hit, item_ids of the documents with a hit (bounded by the document)."""
    hits, item_windows = find_windows(docs, items, scratch, window, shingle)
    found = scratch.store(
        hits.groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end")))).alias("spans"),
             F.collect_set("window_id").alias("window_ids"))
        .withColumn("n_hit", F.expr(COVERED)), "found")
    n = item_windows.count()
    named = (found.select("doc_id", "text_key", F.explode("window_ids").alias("window_id"))
             .join(_maybe_broadcast(item_windows, n), "window_id")
             .groupBy("doc_id", "text_key")
             .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids")))
    named = named.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), "item_ids")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & F.col("text_key").eqNullSafe(F.col("t"))
    return found.drop("window_ids").join(named, same, "left").drop("d", "t")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, item_ids, spans, contaminated."""
    keyed = _keyed(docs)
    found = _per_document(keyed, items, Scratch(docs.sparkSession, "decontaminate"), window, shingle)
    found = found.withColumnsRenamed({"doc_id": "d", "text_key": "t"})
    same = F.col("doc_id").eqNullSafe(F.col("d")) & F.col("text_key").eqNullSafe(F.col("t"))
    counted = keyed.select("doc_id", "text_key", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return counted.join(found, same, "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"), "spans",
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """The documents, with all their columns, that no benchmark window occurs in."""
    found = _per_document(_keyed(docs), items, Scratch(docs.sparkSession, "decontaminate"), window, shingle)
    p = free_prefix(docs)
    bad = found.select(F.col("doc_id").alias(p + "d"), F.col("text_key").alias(p + "t"))
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col(p + "d"))
                     & F.xxhash64(docs["text"]).eqNullSafe(F.col(p + "t")), "left_anti")
