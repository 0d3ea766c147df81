"""The corpus pipeline: toxic documents go, one of each group of near copies stays, documents with benchmark
passages go, sources are mixed to their weights, and what is left is dealt to shards.

Every stage takes (spark, docs, sf_dir) and works on all rows of its predecessor; all but the last
return the columns of ``docs``. Rows with nulls, empty texts and repeated rows are treated as the
operators state; a table without rows gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callspark.llm import decontaminate, jaccard_join, mixing, sharding, toxicity
from callspark.llm.common import table, written


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out the documents that the classifier, trained on the labels, rejects."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each component of linked documents."""
    return jaccard_join.one_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out the documents in which a window of a benchmark item occurs."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and leaves out documents so that sources come near their weights."""
    return mixing.copies(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deals all rows to shards of nearly equal bytes."""
    return sharding.shard(docs)[0]


STAGES = [
    ("toxicity", toxic_documents),
    ("jaccard_join", near_duplicates),
    ("decontamination", benchmark_passages),
    ("mixing", source_mix),
    ("sharding", shards),
]

#: A trained classifier, components and seeded hashes are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
