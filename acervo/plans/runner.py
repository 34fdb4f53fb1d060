"""Run several sources; one that fails does not stop the others."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.sinks import catalog, checkpoints
from acervo.sources.base import Source

log = logging.getLogger(__name__)


def _write(good: DataFrame, source: Source, table: str) -> None:
    order = [F.expr(o.removesuffix(" desc")).desc() if o.endswith(" desc") else F.expr(o) for o in source.order] or None
    if source.mode == "upsert":
        catalog.upsert_table(good, table, source.key, order)
    elif source.mode == "replace":
        catalog.replace_rows_table(good, table, source.key, order)
    elif source.mode == "truncate":
        catalog.truncate_and_load(good, table)
    else:
        catalog.append_load(good, table)


def run_sources(spark: SparkSession, sources: Iterable[Source], namespace: str, run_time: datetime) -> DataFrame:
    """Outcome per source: ``(name, outcome, message)``. Rejects go to ``<name>_rejects``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")
    outcomes = []
    for source in sources:
        try:
            good, rejects = source.read(spark)
            _write(good, source, f"{namespace}.{source.name}")
            catalog.truncate_and_load(rejects, f"{namespace}.{source.name}_rejects")
            checkpoints.save_value(spark, f"{namespace}.etl_checkpoints", source.name, "completed", run_time)
            outcomes.append((source.name, "processed", None))
        except Exception as problem:
            log.exception("source %s failed", source.name)
            outcomes.append((source.name, "errors", str(problem).splitlines()[0]))
    return spark.createDataFrame(outcomes, "name string, outcome string, message string").orderBy(F.col("name"))
