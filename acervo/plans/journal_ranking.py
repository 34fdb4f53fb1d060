"""Yearly journal ranking: parse, diff against the stored year, write, check."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from acervo.operators.digests import diff
from acervo.operators.merge import apply_diff, diff_summary
from acervo.session import materialise
from acervo.sinks.catalog import clean_surplus, overwrite_partitions
from acervo.sinks.checkpoints import save_value
from acervo.sources.ranking import KEY, read_ranking


def load_year(spark: SparkSession, path: str, table: str, checkpoints: str, year: int, run_time: datetime) -> dict | None:
    """Counts per action, rejects and the count check of one year; None without data.

    Only the partition of the year is rewritten, and only when something changed.
    """
    good, bad = read_ranking(spark, path, year)
    incoming = materialise(good, "ranking")
    expected = incoming.count()
    if expected == 0:
        return None
    if spark.catalog.tableExists(table):
        stored = spark.table(table).where(F.col("year") == year)
        actions = diff(stored, incoming, [KEY, "year"])
        state = apply_diff(stored, incoming, [KEY, "year"])
    else:
        actions = incoming.select(KEY, F.lit("insert").alias("action"))
        state = incoming
    # at most four rows
    result = {r["action"]: r["n"] for r in diff_summary(actions).collect()}
    if result.get("insert") or result.get("update"):
        if spark.catalog.tableExists(table):
            known = spark.table(table).columns
            for name in [n for n in state.columns if n not in known]:
                spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{name}` {state.schema[name].dataType.simpleString()})")
            absent = {n: F.lit(None) for n in spark.table(table).columns if n not in state.columns}
            overwrite_partitions(state.withColumns(absent), table)
        else:
            state.write.partitionBy("year").saveAsTable(table)
        result["check"] = clean_surplus(spark, table, year, KEY, sorted(spark.table(table).columns), expected)
    result["rejects"] = bad.count()
    save_value(spark, checkpoints, f"ranking_{year}", "completed", run_time)
    return result
