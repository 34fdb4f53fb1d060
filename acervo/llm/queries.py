"""Registered queries of the subpackage, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.catalogue.registry import table
from acervo.llm import (
    html_extract,
    lexical_search,
    line_dedup,
    mixing,
    packing,
    periodic_runs,
    quality_rules,
    recurrent_lm,
    secret_scan,
    simhash,
    token_codec,
    topk_index,
    url_filter,
)
from acervo.llm import sql as oracle

Query = Callable[[SparkSession, str], DataFrame]


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


def op6_token_codec(spark: SparkSession, folder: str) -> DataFrame:
    return token_codec.round_trip(table(spark, folder, "documents")).drop("ids_bytes")


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op4_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(table(spark, folder, "pages"))


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, folder, "pages")).drop("purity")


def op9_recurrent_lm(spark: SparkSession, folder: str) -> DataFrame:
    return recurrent_lm.score(table(spark, folder, "documents"))


def op10_topk_index(spark: SparkSession, folder: str) -> DataFrame:
    return topk_index.top_k(table(spark, folder, "embeddings"))


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, folder, "documents"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.find_runs(table(spark, folder, "documents"), plant=True)


QUERIES: dict[str, Query] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_line_dedup": op2_line_dedup,
    "op3_packing": op3_packing,
    "op4_html_extract": op4_html_extract,
    "op5_url_filter": op5_url_filter,
    "op6_token_codec": op6_token_codec,
    "op7_quality_rules": op7_quality_rules,
    "op8_simhash": op8_simhash,
    "op9_recurrent_lm": op9_recurrent_lm,
    "op10_topk_index": op10_topk_index,
    "op11_lexical_search": op11_lexical_search,
    "op12_secret_scan": op12_secret_scan,
    "op13_periodic_runs": op13_periodic_runs,
}
SQL: dict[str, str] = {
    "op1_mix_sources": oracle.MIX,
    "op2_line_dedup": oracle.LINES,
    "op5_url_filter": oracle.URLS,
    "op10_topk_index": oracle.TOP,
    "op11_lexical_search": oracle.SEARCH,
}
