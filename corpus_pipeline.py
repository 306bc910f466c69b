"""A training-data pipeline: quality rules, near-dedup, decontamination, secret removal, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next stage's docs.
All but the last return the columns of ``documents``; the last adds the token ids of each remaining text.
Rows keep NULLs in any column; a NULL or empty text fails the quality rules and goes in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tokenlake.llm.byte_bpe import encode_and_decode, multilingual_ranks
from tokenlake.llm.common import table
from tokenlake.llm.decontaminate import decontaminate
from tokenlake.llm.near_dedup import one_of_each
from tokenlake.llm.quality_rules import apply_rules
from tokenlake.llm.secret_scan import redact
from tokenlake.workspace import Workspace


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return apply_rules(docs).filter("kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, the first by id and content, of each group of near duplicates; of repeated rows one stays."""
    return one_of_each(docs)


def clean_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return decontaminate(docs, items).filter("NOT contaminated").select(*docs.columns)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a mark in place of each secret."""
    return redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their packed ids, token count and the digests of ids and decoded bytes."""
    return encode_and_decode(docs, multilingual_ranks()).drop("decoded")


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", clean_benchmark),
    ("secret_scan", remove_secrets),
    ("byte_bpe", tokens),
]

# Neither the near duplicates nor the encoding can be expressed in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result is written to the shared folder and read again."""
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = work.save(stage(spark, docs, sf_dir), f"{at}-{name}")
    return docs
