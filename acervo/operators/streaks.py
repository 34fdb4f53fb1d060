"""Stop rule of an id walk: the first streak of N misses ends it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def streak_end(log: DataFrame, idx: str, hit: str, n: int, start: int) -> DataFrame:
    """One row: the index at which the n-th miss in a row happens.

    Ids are cut in buckets of width n, named by their first id. Two hits of one bucket are never n+1
    apart, so only the last hit of a bucket and the first hit of the next
    bucket can frame the streak: two aggregates and an equi-join, no window.
    """
    hits = log.where(F.col(hit) & (F.col(idx) >= start)).select(F.col(idx).cast("bigint").alias("at"))
    origin = log.sparkSession.range(1).select(F.lit(start - 1).cast("bigint").alias("at"))
    buckets = (
        hits.unionByName(origin)
        .groupBy((F.col("at") - F.pmod("at", F.lit(n))).alias("bucket"))
        .agg(F.min("at").alias("first_hit"), F.max("at").alias("last_hit"))
    )
    following = buckets.select((F.col("bucket") - n).alias("bucket"), F.col("first_hit").alias("next_hit"))
    gap = F.col("next_hit") - F.col("last_hit")
    return (
        buckets.join(following, "bucket", "left")
        .where(gap.isNull() | (gap > n))
        .agg((F.min("last_hit") + n).alias("stop_at"))
    )


def streak_stop(log: DataFrame, idx: str, hit: str, n: int, start: int = 1, max_index: int | None = None) -> DataFrame:
    """Log rows the walk visits, up to and including the stop, with the stop reason.

    ``max_index`` of 0 or none means no bound.
    """
    end = streak_end(log, idx, hit, n, start).scalar()
    bound = F.lit(max_index or None).cast("bigint")
    reason = F.when(bound < end, "max_index").otherwise("missing_streak")
    return log.where((F.col(idx) >= start) & (F.col(idx) <= F.least(end, bound))).withColumn("stop_reason", reason)
