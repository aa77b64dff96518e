"""Stages from raw documents to shards; each is written as Parquet and read again as the next one's documents."""

from pyspark.sql import functions as F

from corpusmill.llm import bagminhash, decontaminate, mixing, sharding, toxicity
from corpusmill.session import scratch_path, table


def nontoxic(spark, docs, sf_dir):
    """Documents below the toxicity threshold."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def distinct_texts(spark, docs, sf_dir):
    """One document of each group of near copies."""
    return bagminhash.without_duplicates(docs)


def clean_of_benchmark(spark, docs, sf_dir):
    """Documents that overlap with no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark, docs, sf_dir):
    """Whole readings of the curriculum mix, in training order; documents may repeat, or be left out by their source's target."""
    return mixing.mixed_documents(docs)


def shards(spark, docs, sf_dir):
    """Shard and place of every document, with its columns; one that is named like a column of the shards gets `input_`."""
    own = ["size", "text_crc32", "law", "vslot", "shard", "slot", "grown_shard"]
    kept = [F.col(f"row.`{c}`").alias(f"input_{c}" if c.lower() in own else c) for c in docs.columns]
    return sharding.shard(docs, keep=docs.columns).select(*kept, *own)


STAGES = [
    ("toxicity", nontoxic),
    ("near_duplicates", distinct_texts),
    ("decontamination", clean_of_benchmark),
    ("mixing", mix),
    ("sharding", shards),
]

#: The stages train models, hash with xxHash and link near copies: no SQL twin. tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
