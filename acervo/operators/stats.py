"""Load counters, roll-ups, rates and run outcomes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def load_counters(rows: DataFrame, by: Sequence[str], tests: Mapping[str, Column]) -> DataFrame:
    """Number of rows passing each test, per group."""
    return rows.groupBy(*by).agg(*[F.count_if(test).alias(name) for name, test in tests.items()])


def rolled_up(rows: DataFrame, entity: str, file: str, tests: Mapping[str, Column]) -> DataFrame:
    """Counters per file, per entity (file null) and in total (both null)."""
    return rows.rollup(entity, file).agg(
        *[F.count_if(test).alias(name) for name, test in tests.items()],
        F.grouping_id().cast("int").alias("level"),
    )


def with_rates(counters: DataFrame, done: str, total: Column, seconds: Column) -> DataFrame:
    return counters.withColumns(
        {
            "per_second": F.when(seconds > 0, F.col(done) / seconds),
            "percent_done": F.when(total > 0, F.col(done) * 100.0 / total),
        }
    )


OUTCOMES = ("processed", "skipped", "empty", "errors")


def outcome_counts(folders: DataFrame, outcome: str) -> DataFrame:
    """One row: number of folders and of each outcome."""
    return folders.agg(
        F.count("*").alias("folders"),
        *[F.count_if(F.col(outcome) == o).alias(o) for o in OUTCOMES],
    )
