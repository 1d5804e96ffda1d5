"""A corpus pipeline: quality rules, exact and near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every result as Parquet in the shared folder and reads it as the next stage's
documents.

Defined results: a null or empty text has no words and fails the quality rules; no
text is cut; of equal texts the row of the largest id stays, of near-equal ones that
of the smallest, with ties and null ids as the operators say; repeated rows are one
after the second stage and may be repeated again by the mix. Extra columns pass
through all stages but the last, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm import exact_dedup, mixing, packing, quality_rules, simhash_dedup
from lexiloom.llm.store import stored
from lexiloom.llm.words import tokenizer_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of equal texts stays: that of the largest id."""
    return exact_dedup.drop_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: that of the smallest id."""
    return simhash_dedup.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their weights."""
    # The mix adds a shard and a place; columns of documents with these names stay as they are.
    kept = {c: f"__kept_{i}" for i, c in enumerate(docs.columns) if c.lower() in ("shard", "place")}
    out = mixing.mix(docs.withColumnsRenamed(kept))
    return out.select(*[F.col(f"`{kept.get(c, c)}`").alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of binary length, with their token ids."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL has neither the tokenizer nor the hash of the fingerprints; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs)
    return docs
