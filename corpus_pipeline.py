"""Corpus pipeline: each stage applies one corpus operator to what the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next one's docs. Toxic documents go; of each group of near duplicates one document stays; documents
with benchmark items go; sources are brought to their weights; the rest is dealt to shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.llm import chosen_path, decontaminate, mixing, ring, toxicity
from tributary.llm.common import prepare, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_harmless(docs, table(prepare(spark), sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return chosen_path.keep_one_of_each(docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_unleaked(docs, table(prepare(spark), sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return ring.shard_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_leaked),
    ("mixing sources", mix_sources),
    ("sharding", shard),
]

# Learned scores and hashed joins are beyond SQL. tests/llm compares the operators with brute force (toxicity: held-out
# accuracy), and what each stage keeps with what its operator says of the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
