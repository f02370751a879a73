"""A corpus pipeline over ``documents``: every stage is written as Parquet and read again."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loanlake.llm import ftrl, hyperminhash, mixing, piece_agenda, weak_supervision
from loanlake.llm.common import Scratch


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more by the classifier go."""
    return ftrl.drop_toxic(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the posterior of the votes reject go."""
    return weak_supervision.keep_quality(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates (similarity 0.8 or more) stays."""
    return hyperminhash.keep_one_of_each(spark, docs, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, shuffled by shard."""
    return mixing.mixed_documents(spark, docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length and digests of the ids of every text, and of what they decode to."""
    rows = docs.select("doc_id", "source", "text")
    return piece_agenda.encode(rows, public_tokenizers.path("piece_bpe_32k.model"), digests=True, keep_text=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("source mix", source_mix),
    ("encoding", encoded),
]

#: The verdicts of learned models cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one reads what its predecessor wrote."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    previous = None
    for _, stage in STAGES[:-1]:
        stored = scratch.store(stage(spark, docs, sf_dir))
        if previous is not None:
            scratch.drop(previous)
        docs = previous = stored
    return STAGES[-1][1](spark, docs, sf_dir)
