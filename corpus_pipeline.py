"""Corpus pipeline: language ID, near-duplicate removal, decontamination,
mixing, sharding. Each stage reads what the one before it kept, as Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontam, langid, mixing, sharding, simhash
from strata.llm.common import bound_batches, save, table
from strata.llm.queries import SHARDS


def in_files(docs: DataFrame) -> bool:
    """Whether there are files of ``docs``, which each stage reads from files (see :func:`run`)."""
    return bool(docs.inputFiles())


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the documents' own labels; documents without a language go."""
    bound_batches(spark)
    return langid.drop_unidentified(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group stays, with an id or without."""
    bound_batches(spark)
    return simhash.deduplicate(docs, stored=in_files(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that overlap a benchmark item go, with an id or without."""
    bound_batches(spark)
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), whole_ids=False)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs, stored=in_files(docs))


def kd_sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by shard and slot: every document's place and its text."""
    return sharding.sharded_documents(docs, shards=SHARDS, stored=in_files(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("kd_sharding", kd_sharding),
]

#: Suffix automata and XXH64 fingerprints have no DuckDB counterpart; the
#: tests hold every stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
