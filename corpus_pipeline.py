"""The corpus pipeline: toxic documents go, one document of each near-duplicate group
stays, contaminated documents go, sources are mixed to their target weights, and the
rest is encoded to token ids.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next stage's documents; all but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from commerce_lake.llm import decontaminate, mixing, simhash, toxicity
from commerce_lake.llm.queries import stored_tokens
from commerce_lake.llm.scratch import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from its training fold's labels."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates stays."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a benchmark window occurs in go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; copies are rows of their own."""
    return mixing.copies(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in ORC, read back: doc_id, start, n_tokens, ids_crc32 of every row."""
    return stored_tokens(spark, docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_ids", encode),
]

#: Training, hashing and rounding have no DuckDB form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.store(stage(spark, docs, sf_dir), name)
    return docs
