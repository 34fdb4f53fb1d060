"""Exact global positions and key ranges without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StructField, StructType

from acervo.session import materialise


def row_positions(df: DataFrame, order: Sequence[str], within: Sequence[str] = (), alias: str = "position") -> DataFrame:
    """0-based position of each row in the given total order, per ``within`` group.

    The rows are range-partitioned, so a group that holds a third of them spans
    many partitions. Partition counts (one row per group and partition) give
    the offset of each part; only those are windowed.
    """
    sort = [*within, *order]
    pinned = materialise(
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__at", F.monotonically_increasing_id()),
        "positions",
    )
    part = ["__part", *within]
    counts = pinned.groupBy(*part).agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = W.partitionBy(*within).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    matched = F.col("r.__part") == F.col("o.__part")
    for c in within:
        matched = matched & F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}"))
    return (
        pinned.alias("r")
        .join(offsets.alias("o"), matched)
        .select(
            *[F.col(f"r.{c}") for c in df.columns],
            (F.col("__before") + F.col("__at") - F.col("__first")).alias(alias),
        )
    )


#: Keys that the first pass of ``key_ranges`` counts between, and sampled keys for each of them.
PIVOTS, SAMPLED = 256, 16


def _interval(key: Column, pivots: Sequence, kind: DataType) -> Column:
    """2i for a key between the i-th pivot and the next, 2i - 1 for one equal to the i-th, -1 for a null.

    The pivots before a key are counted first by blocks, then in its block, so a row takes few comparisons.
    """
    if not pivots:
        return F.when(key.isNull(), -1).otherwise(0)
    size = max(1, round(len(pivots) ** 0.5))
    made = [F.lit(p).cast(kind) for p in pivots]
    blocks = [F.array(*made[at : at + size]) for at in range(0, len(made), size)]
    before = F.size(F.filter(F.array(*made[::size]), lambda p: p <= key))
    block = F.get(F.array(*blocks), before - 1)
    place = F.when(before == 0, 0).otherwise((before - 1) * size + F.size(F.filter(block, lambda p: p <= key)))
    return F.when(key.isNull(), -1).otherwise(2 * place - F.when(F.exists(block, lambda p: p == key), 1).otherwise(0))


def key_ranges(df: DataFrame, key: str, n: int, pivots: int = PIVOTS) -> DataFrame:
    """``(min_id, max_id)`` of at most ``n`` half-open ranges of near-equal size.

    The first start and the last end are ``""`` (open). An empty table gives
    one range that is open at both ends; null keys come first.

    Exact by selection: sampled pivots, one count of the rows between and at them, then only the rows of intervals
    that a boundary falls into are ordered, about n / pivots of all. A key that many rows share is almost surely a
    pivot; a boundary at one needs no more. The sample settles what is read again, never the result.
    """
    spark, kind = df.sparkSession, df.schema[key].dataType
    keys = df.select(F.col(key).alias("__key"))
    total = keys.count()
    share = min(1.0, pivots * SAMPLED / max(1, total))
    # about pivots * SAMPLED keys, whatever the rows number
    some = [row[0] for row in keys.where("__key is not null").sample(share, 7).orderBy("__key").collect()]
    chosen = list(dict.fromkeys(some[:: max(1, len(some) // pivots)]))
    placed = keys.withColumn("__interval", _interval(F.col("__key"), chosen, kind))
    counts = sorted((row[0], row[1]) for row in placed.groupBy("__interval").count().collect())
    step, before, known, open_ = max(1, -(-total // n)), 0, [], []
    for interval, count in counts:
        for position in range(-(-max(before, 1) // step) * step, before + count, step):
            if interval % 2:
                known.append((position, None if interval < 0 else chosen[interval // 2]))
            else:
                open_.append((position, interval, position - before))
        before += count
    schema = StructType([StructField("position", LongType()), StructField("__key", kind)])
    cuts = spark.createDataFrame(known, schema)
    if open_:
        within = sorted({interval for _, interval, _ in open_})
        ordered = row_positions(placed.where(F.col("__interval").isin(within)), ["__key"], within=["__interval"], alias="__at")
        wanted = spark.createDataFrame(open_, "position long, __interval int, __at long")
        cuts = cuts.unionByName(ordered.join(wanted, ["__interval", "__at"]).select("position", "__key"))
    # at most n-1 cuts plus the open end: one small window
    ends = cuts.select(F.col("__key").cast("string").alias("cut"), "position").unionByName(
        spark.range(1).select(F.lit("").alias("cut"), F.lit(None).cast("bigint").alias("position"))
    )
    in_order = W.orderBy(F.col("position").asc_nulls_last())
    return ends.select(
        F.lag("cut", 1, "").over(in_order).alias("min_id"), F.col("cut").alias("max_id")
    )
