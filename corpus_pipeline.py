"""Corpus preparation: quality rules, exact dedup, near-dedup, mixing and encoding.

Each stage takes and returns the columns of documents, but for the last, which
returns the places, token ids and digests of what is left.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import bpe, exact_dedup, minhash_dedup, mixing, quality_rules
from sparkloom.llm.common import cut, shared_dir


#: Where the last mixing stage over the tables of a folder left its places; each run has a folder of its own.
PLACES: dict[str, str] = {}


def _places(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, mix_slot, mix_offset as the mixing stage found them; from the rows alone where another process mixed them."""
    if sf_dir in PLACES:
        return spark.read.parquet(PLACES[sf_dir])
    keys = cut(docs.select("doc_id", "source").distinct(), "pipeline-keys")
    return mixing.schedule(keys, mixing.root_weights(docs)).select("doc_id", "source", "mix_slot", "mix_offset")


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.quality_filter(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 80 % of five-word shingles."""
    return minhash_dedup.near_dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that interleaves the sources; their places go to a table of this run, as files don't keep an order."""
    path = f"{shared_dir(spark)}/pipeline-places-{uuid.uuid4().hex}"
    out = mixing.mix(docs, places=path)
    PLACES[sf_dir] = path
    return out


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, token ids and digest of the decoded text of each document, in mixed order within each partition."""
    places = _places(spark, docs, sf_dir).select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), "mix_slot", "mix_offset")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source"))
    # texts are moved, not token ids, and in the same way at any size
    placed = docs.select("doc_id", "lang", "source", "text").join(places.hint("merge"), same, "left").sortWithinPartitions(F.col("mix_slot").asc_nulls_last(), "mix_offset")
    found = bpe.encode_decode(placed, bpe.tokenizer_path())
    return found.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"), "mix_slot", "mix_offset")


STAGES = [("quality_rules", rules), ("exact_dedup", exact), ("minhash_dedup", near), ("mixing", mixed), ("bpe", encoded)]
#: Near-duplicates and merges are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
