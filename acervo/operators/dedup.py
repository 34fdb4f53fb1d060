"""Deduplication and first-per-group selection.

Every selection needs a total order, so that a re-run gives the same rows.
``row_number() <= k`` lets Spark keep at most k rows per key on the map side
(WindowGroupLimit) before the shuffle: a key that holds a third of the rows
sends k rows per task, not a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_RANK = "__rank"


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = _RANK) -> DataFrame:
    """The first ``k`` rows of each key, with their 1-based rank."""
    if not order:
        raise ValueError("top_per_key needs a total order")
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_per_key(df, keys, order, 1).drop(_RANK)


def latest_per_group(df: DataFrame, keys: Sequence[str], time: str, tie: Sequence[Column]) -> DataFrame:
    """Latest row by a time text; a missing time sorts first of all, ties by ``tie``."""
    latest_first = F.coalesce(F.col(time).cast("string"), F.lit("")).desc()
    return first_per_key(df, keys, [latest_first, *tie])


def latest_matching(
    files: DataFrame, keys: Sequence[str], name: str, pattern: str, updated: str, created: str, position: str
) -> DataFrame:
    """Per group the latest file whose name matches, the last listed of equals;
    without a match the last listed file."""
    matches = F.coalesce(F.col(name).rlike(pattern), F.lit(False))
    time = F.when(matches, F.coalesce(F.col(updated), F.col(created), F.lit("")))
    return first_per_key(
        files, keys, [matches.desc(), time.desc_nulls_last(), F.col(position).desc()]
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def surplus_rows(df: DataFrame, keys: Sequence[str], row_id: str) -> DataFrame:
    """The rows a clean-up deletes: all but the smallest ``row_id`` of each key.

    One row per surplus row, so no list grows with the number of copies.
    """
    keep = df.groupBy(*keys).agg(F.min(row_id).alias("__keep"), F.count("*").alias("copies"))
    # null keys form a group like any other
    same_key = [F.col(f"d.{k}").eqNullSafe(F.col(f"k.{k}")) for k in keys]
    return (
        df.alias("d")
        .join(keep.where("copies > 1").alias("k"), same_key)
        .where(F.col(f"d.{row_id}") != F.col("__keep"))
        .select("d.*")
    )


def distinct_nested(df: DataFrame, array: str, value: str, alias: str) -> DataFrame:
    """Distinct values of a field inside an array of structs."""
    return (
        df.select(F.explode(array).alias("__e"))
        .select(F.col(f"__e.{value}").alias(alias))
        .where(F.col(alias).isNotNull())
        .distinct()
    )
