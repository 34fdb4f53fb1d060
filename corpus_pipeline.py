"""A training corpus from ``documents``: filter, deduplicate, mix and pack, each stage by one operator of acervo.llm."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from acervo.catalogue.registry import table
from acervo.llm import line_dedup, mixing, packing, quality_rules, simhash
from acervo.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base or a learned rule go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of three lines and more stay where they occur first."""
    return line_dedup.dedup_lines(docs).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources reach their weights: documents are repeated, left out, or cut at the budget."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix),
    ("packing", pack),
]
#: Learned rules, fingerprints and tokenizers have no SQL form; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; each reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
