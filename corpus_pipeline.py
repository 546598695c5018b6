"""The corpus pipeline: five stages over documents, each one operator of the llm subpackage.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but the
last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from paceline.llm.decontamination import contaminated
from paceline.llm.exact_dedup import drop_copies
from paceline.llm.jaccard_join import keep_one
from paceline.llm.packing import pack_documents
from paceline.llm.queries import public_tokenizer
from paceline.llm.toxicity import drop_toxic
from paceline.session import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return drop_copies(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of five-word Jaccard similarity 0.8 connect, the smallest id stays."""
    return keep_one(docs, width=5, threshold=0.8)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go; a null id cannot be named and stays."""
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = staged(found.select(F.col("doc_id").alias("_gone")).distinct(), "contaminated")
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of sequences."""
    return pack_documents(docs, public_tokenizer())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: The trained and tokenising stages have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
