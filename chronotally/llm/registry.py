"""The registered queries over the pipeline's operators, each on its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotally.llm import (
    binary, bpe, chat, chat_sql, filter_audit, filter_audit_sql, jaccard, line_dedup, neighbours, packing, repair, sharding, toxicity,
    warc, warc_sql,
)
from chronotally.llm.quality import quality
from chronotally.session import run_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query("op1_bpe_round_trip")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text by the transducer and the text decoded from them, as digests."""
    return bpe.round_trip_digests(
        _table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


@_query("op9_quality_rules")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and the verdict of line-first cleaning."""
    found = quality(_table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "lost_words", F.crc32("cleaned").alias("cleaned_crc32"),
    )


def toxicity_model(spark: SparkSession, folder: str) -> toxicity.Model:
    """Fitted on rows that are not held out."""
    labels = _table(spark, folder, "labels").filter(~toxicity.held_out())
    return toxicity.train(_table(spark, folder, "documents"), labels)


@_query("op2_toxicity")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity scores of every text."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, folder))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@_query("op3_binary_ids")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text with an end id, written to files and read back from them."""
    path = run_folder(spark, "ids")
    binary.write_ids(_table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return binary.read_ids(spark, path, with_ids=False)


@_query("op10_packing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 1024 ids."""
    return packing.pack(
        _table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0, with_ids=False
    )


@_query("op4_shuffled_shards")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in eight shards of equal counts, in a random order."""
    return sharding.shuffled_shards(_table(spark, folder, "documents"), carry=["doc_id"])


@_query("op5_chat_formatting", chat_sql.SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations that are no snapshot of a longer one, rendered."""
    return chat.collapse(_table(spark, folder, "conversations"))


@_query("op7_nearest_neighbours")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest of every fiftieth vector."""
    return neighbours.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@_query("op8_ngram_jaccard")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose four-word shingles overlap by 85 of 100."""
    return jaccard.groups(_table(spark, folder, "documents"))


@_query("op6_line_dedup")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of every document that repeat an earlier one, and a checksum of what is left."""
    cut = line_dedup.without_repeated_lines(_table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", F.size("removed_lines").cast("bigint").alias("n_removed"),
        F.array_join("removed_lines", " ").alias("removed_lines"), F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
    )


@_query("op13_filter_audit", filter_audit_sql.SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """What five filters remove at each step of each of their orders."""
    return filter_audit.audit(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@_query("op11_warc", warc_sql.SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to WARC files and read back by its URL."""
    path, pages = run_folder(spark, "warc"), _table(spark, folder, "pages")
    warc.write_archive(pages, path)
    found, kind = warc.read_urls(spark, path, pages, with_payload=False), pages.schema["page_id"].dataType
    return found.select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


@_query("op12_conversation_repair")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """The faults of damaged conversations and the cheapest edits that mend them."""
    return repair.repair(_table(spark, folder, "conversations"))
