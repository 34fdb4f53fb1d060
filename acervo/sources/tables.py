"""Catalog table scans, table families, and the endpoint registry."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, table: str, where: Column | None = None, columns: list[str] | None = None) -> DataFrame:
    df = spark.table(table)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def table_names(spark: SparkSession, namespace: str, pattern: str = "") -> list[str]:
    """Persistent tables of a namespace whose name matches, sorted."""
    rows = spark.catalog.listTables(namespace)
    return sorted(t.name for t in rows if not t.isTemporary and re.search(pattern, t.name))


def family_scan(spark: SparkSession, namespace: str, pattern: str = r"^dspace.*records$") -> DataFrame | None:
    """Union by name of the tables of a family with a ``table_name`` column."""
    frames = [
        spark.table(f"{namespace}.{name}").withColumn("table_name", F.lit(name))
        for name in table_names(spark, namespace, pattern)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None


REGISTRY_SCHEMA = (
    "endpoint string, enabled boolean, name string, ror string, url string, metadataPrefix string, "
    "rate_limit struct<calls:int,secs:int>, checkpoint struct<enabled:boolean,selective:boolean,days:int>"
)


def endpoint_registry(spark: SparkSession, path: str, enabled_only: bool = True) -> DataFrame:
    """Registry rows from JSON lines; by default the enabled ones."""
    rows = spark.read.schema(REGISTRY_SCHEMA).json(path)
    return rows.where("enabled") if enabled_only else rows
