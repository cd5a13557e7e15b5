"""Bounded, reproducible samples of labelled documents for classifier training."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Longest text that is used for training (scoring reads whole texts of any length).
MAX_TRAIN_CHARS = 50_000


def remainder(doc_id, modulus: int):
    """crc32 of the id's decimal text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def chosen_ids(labels: DataFrame, label: str, usable, per_class: dict[int, int]) -> DataFrame:
    """doc_id and y of at most ``per_class[y]`` label rows for each y, chosen by a hash of the id.

    ``usable`` is a predicate on doc_id (the training fold).  Rows with a null
    id or label are not used; an id with several label rows counts once per
    distinct label.
    """
    chosen = None
    for y, n in sorted(per_class.items()):
        part = (labels.select("doc_id", F.col(label).cast("int").alias("y"))
                .where(usable(F.col("doc_id")) & (F.col("y") == y)).distinct()
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(n))
        chosen = part if chosen is None else chosen.unionByName(part)
    return chosen


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, usable, per_class: dict[int, int]) -> DataFrame:
    """doc_id, text and y of the chosen ids' rows, without texts over ``MAX_TRAIN_CHARS``.

    Ids are chosen from the slim label table first, so the documents are scanned
    once against a broadcast of at most ``sum(per_class)`` ids.
    """
    return (docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
            .where(F.length("text") <= MAX_TRAIN_CHARS)
            .join(F.broadcast(chosen_ids(labels, label, usable, per_class)), "doc_id").select("doc_id", "text", "y"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable, per_class: dict[int, int],
                    ) -> list[tuple[str, int]]:
    """(text, y) of ``labelled_texts``, by id, label and text; equal rows count once."""
    rows = labelled_texts(docs, labels, label, usable, per_class).collect()
    return [(r.text, r.y) for r in sorted(set(rows), key=lambda r: (r.doc_id, r.y, r.text))]
