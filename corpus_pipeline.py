"""The corpus pipeline: raw documents to packed token ids.

Toxic documents and near copies go, then documents that contain test items;
the rest is mixed by source, without cutting any source, and written as
packed token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickwell.llm import leaks, mixing, neardup, tokenfile, toxicity
from tickwell.llm.queries import BYTE_BPE, END_ID
from tickwell.llm.tables import written

#: How often a document of a small source may be used.
MOST_REPEATS = 1.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose nearest labelled examples are toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return neardup.drop_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that contain a test item."""
    return leaks.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources repeated, none cut: every document stays at least once."""
    return mixing.mix(docs, budget=None, most_repeats=MOST_REPEATS).select(*docs.columns)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, written as packed segments and read back."""
    return tokenfile.token_file(docs, BYTE_BPE, END_ID)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("benchmark_leaks", drop_leaks),
    ("source_mix", mix_sources),
    ("token_file", pack_tokens),
]

#: Compression, tokenising and sampling have no SQL; tests compare with plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
