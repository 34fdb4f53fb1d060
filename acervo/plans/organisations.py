"""Organisation registry: one wrapped JSON file, archived and replaced."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from acervo.sinks.catalog import archive, load_by_content
from acervo.sources.wrapped import read_wrapped


def load_organisations(
    spark: SparkSession, path: str, namespace: str, table: str, run_time: datetime, is_new: bool = True
) -> str:
    """Load the file; the way it was loaded, or ``unchanged`` when it is not new.

    The file is read before the old namespace is archived: a bad file changes nothing.
    """
    if not is_new:
        return "unchanged"
    documents, rejects = read_wrapped(spark, path)
    if not rejects.isEmpty():
        raise ValueError(f"{path} holds neither a list nor an object")
    archive(spark, namespace, run_time)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")
    return load_by_content(documents, f"{namespace}.{table}")
