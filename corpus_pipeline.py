"""From raw documents to packed token sequences, in stages that hand on a written table.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it kept; all but
the last return the columns of documents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotally.llm import jaccard, line_dedup, packing, quality, toxicity
from chronotally.llm.tables import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("bigint"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bad lines go, and documents that lose too much by it or fail the base rules."""
    return quality.kept_documents(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.5 or more go. The model learns from what is left of the
    labelled documents that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~toxicity.held_out())
    model = toxicity.train(docs, labels)
    return toxicity.score(docs, model).filter("predicted = 0").drop("score", "predicted")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go, and documents of which no word is left."""
    cut = line_dedup.without_repeated_lines(docs).drop("removed_lines")
    return _with_length(cut).filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8, the one with the least id stays."""
    return jaccard.representatives(docs, size=5, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as ids in sequences of at most 1024."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_duplicates),
    ("packing", packed),
]

#: No SQL form: a trained model, a tokenizer and dynamic programming are among the stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
