"""Snapshot scan: gzip NDJSON partitions of one entity, with a rejects table."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.functions.nested import is_object, truthy
from acervo.functions.predicates import not_flagged
from acervo.functions.text import strip_text
from acervo.sources.paths import has_files

log = logging.getLogger(__name__)

# The entities of a snapshot.
ENTITIES = (
    "authors",
    "awards",
    "concepts",
    "continents",
    "countries",
    "domains",
    "fields",
    "funders",
    "institution-types",
    "institutions",
    "keywords",
    "languages",
    "licenses",
    "publishers",
    "sdgs",
    "source-types",
    "sources",
    "subfields",
    "topics",
    "work-types",
    "works",
)

LINE_SCHEMA = "value string, updated_date date, file_path string"


def entity_path(base: str, entity: str) -> str:
    if entity not in ENTITIES:
        raise ValueError(f"entity must be one of {', '.join(ENTITIES)}; got {entity!r}")
    return f"{base.rstrip('/')}/data/{entity}"


def snapshot_lines(spark: SparkSession, base: str, entity: str) -> DataFrame:
    """Raw lines with ``updated_date`` from the directory names and the file path."""
    path = entity_path(base, entity)
    if not has_files(spark, path, ".gz"):
        log.warning("no snapshot files below %s", path)
        return spark.createDataFrame([], LINE_SCHEMA)
    lines = spark.read.option("pathGlobFilter", "*.gz").text(path)
    dated = F.col("updated_date").cast("date") if "updated_date" in lines.columns else F.lit(None).cast("date")
    return lines.select("value", dated.alias("updated_date"), F.col("_metadata.file_path").alias("file_path"))


def snapshot_files(lines: DataFrame) -> DataFrame:
    """Files a scan read, with their number of lines."""
    return lines.groupBy("file_path").agg(F.count("*").alias("lines"))


def reject_reason(raw: Column, key: str = "id") -> Column:
    """Why a parsed line is no record; null for a good one."""
    return (
        F.when(raw.isNull(), "bad_json")
        .when(~is_object(raw), "not_an_object")
        .when(~truthy(F.try_variant_get(raw, f"$.{key}", "variant")), f"no_{key}")
    )


def parse_lines(lines: DataFrame, key: str = "id", flag: str | None = None) -> DataFrame:
    """Non-blank lines with key, ``raw`` VARIANT, ``reason`` and the ``line`` itself
    (both null when good), and ``flagged`` (true for rows a filter drops without counting them as errors)."""
    text = strip_text(F.col("value"))
    parsed = lines.withColumn("line", text).where(F.col("line") != "").withColumn("raw", F.try_parse_json("line"))
    flagged = F.lit(False)
    if flag:
        exact = F.try_variant_get("raw", f"$.{flag}", "variant")
        flagged = (F.schema_of_variant(exact) == "BOOLEAN") & ~not_flagged(F.try_variant_get("raw", f"$.{flag}", "boolean"))
    reason = reject_reason(F.col("raw"), key)
    return parsed.select(
        F.try_variant_get("raw", f"$.{key}", "string").alias(key),
        "raw",
        *[c for c in lines.columns if c != "value"],
        F.when(reason.isNotNull(), F.col("line")).alias("line"),
        reason.alias("reason"),
        F.coalesce(flagged, F.lit(False)).alias("flagged"),
    )


def split_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = parsed.where(F.col("reason").isNull() & ~F.col("flagged")).drop("line", "reason", "flagged")
    rejects = parsed.where(F.col("reason").isNotNull()).select("file_path", "line", "reason")
    return good, rejects


def entity_flag(entity: str) -> str | None:
    """Works marked as expansion records are left out; other entities have no such flag."""
    return "is_xpac" if entity == "works" else None


def read_ndjson(spark: SparkSession, base: str, entity: str, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of an entity."""
    return split_parsed(parse_lines(snapshot_lines(spark, base, entity), key, entity_flag(entity)))
