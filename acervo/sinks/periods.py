"""Files by half-year: a load replaces the periods it has rows for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

PERIOD = ("year", "semester")


def write_periods(rows: DataFrame, path: str, period: Sequence[str] = PERIOD) -> None:
    """Write ``rows`` under ``path``, one folder per period; periods without rows stay as they are.

    Rebalancing gathers a period's rows but splits a large one over several files.
    """
    (
        rows.hint("rebalance", *period)
        .write.option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy(*period)
        .parquet(path)
    )
