"""Checkpoint table: the last value per source, and the set of loaded files."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.operators.joins import pending

SCHEMA = "source_id string, last_value string, saved_at timestamp_ntz"
FILES_SCHEMA = "source_id string, file_path string"


def save_value(spark: SparkSession, table: str, source_id: str, value: object, run_time: datetime) -> None:
    """Append the value as JSON text; readers take the latest."""
    row = [(source_id, json.dumps(value, sort_keys=True, default=str), run_time.replace(tzinfo=None))]
    spark.createDataFrame(row, SCHEMA).write.mode("append").saveAsTable(table)


def last_values(spark: SparkSession, table: str) -> DataFrame:
    if not spark.catalog.tableExists(table):
        return spark.createDataFrame([], "source_id string, last_value string")
    newest = F.max_by("last_value", F.struct("saved_at", "last_value"))
    return spark.table(table).groupBy("source_id").agg(newest.alias("last_value"))


def last_value(spark: SparkSession, table: str, source_id: str) -> object | None:
    row = last_values(spark, table).where(F.col("source_id") == source_id).first()
    return None if row is None else json.loads(row["last_value"])


def save_files(files: DataFrame, table: str, source_id: str) -> None:
    """Add file paths to the loaded set. Call it after the data is written."""
    rows = files.select(F.lit(source_id).alias("source_id"), "file_path")
    rows.write.mode("append").saveAsTable(table)


def loaded_files(spark: SparkSession, table: str, source_id: str) -> DataFrame:
    if not spark.catalog.tableExists(table):
        return spark.createDataFrame([], "file_path string")
    return spark.table(table).where(F.col("source_id") == source_id).select("file_path").distinct()


def pending_files(files: DataFrame, table: str, source_id: str) -> DataFrame:
    return pending(files, loaded_files(files.sparkSession, table, source_id), ["file_path"])
