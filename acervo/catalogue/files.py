"""Queries that write the given tables out and load them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.catalogue.registry import query, table
from acervo.functions.names import semester
from acervo.session import scratch_path
from acervo.sinks.documents import stored_documents
from acervo.sinks.periods import write_periods
from acervo.streaming.incremental import load_snapshot

c = F.col


@query("""
    SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS semester
    FROM orders WHERE NOT (year(o_orderdate) = 1997 AND month(o_orderdate) <= 6)
    UNION ALL SELECT o_orderkey, o_totalprice * 2, 1997, 1 FROM orders
    WHERE year(o_orderdate) = 1997 AND month(o_orderdate) <= 6 AND o_orderstatus = 'F'
""")
def period_rewrite(spark: SparkSession, d: str) -> DataFrame:
    """Orders stored by half-year, then a backfill of one half-year that leaves the others alone."""
    path = scratch_path(spark, "periods")
    day = c("o_orderdate")
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", F.year(day).alias("year"), semester(day).alias("semester")
    )

    write_periods(orders.drop("o_orderstatus"), path)
    backfill = orders.where("year = 1997 and semester = 1 and o_orderstatus = 'F'")
    write_periods(backfill.withColumn("o_totalprice", c("o_totalprice") * 2).drop("o_orderstatus"), path)
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", "year", "semester")


@query("""
    SELECT event_id::VARCHAR AS id, CASE WHEN event_type = 'error' THEN 'fixed' ELSE event_type END AS event_type,
           CASE WHEN event_type = 'purchase' THEN value * 2 ELSE value END AS value,
           CASE WHEN event_type = 'error' THEN user_id END AS fixed_by
    FROM events WHERE event_type <> 'view'
""")
def incremental_stream(spark: SparkSession, d: str) -> DataFrame:
    """Events as snapshot files in two dated deliveries; views are flagged works and left out.

    The second delivery corrects purchases (new value) and errors (new type, new
    field, value absent and so kept). Both are loaded by one stream that stops when done.
    """
    base = scratch_path(spark, "snapshot")
    events = table(spark, d, "events")
    first = events.select(
        F.to_json(
            F.struct(c("event_id").cast("string").alias("id"), "event_type", "value", (c("event_type") == "view").alias("is_xpac"))
        ).alias("value"),
        F.lit("2024-01-01").alias("updated_date"),
    )
    corrected = events.where("event_type in ('purchase', 'error')").select(
        F.to_json(
            F.struct(
                c("event_id").cast("string").alias("id"),
                F.when(c("event_type") == "error", "fixed").alias("event_type"),
                F.when(c("event_type") == "purchase", c("value") * 2).alias("value"),
                F.when(c("event_type") == "error", c("user_id")).alias("fixed_by"),
            )
        ).alias("value"),
        F.lit("2024-02-01").alias("updated_date"),
    )
    damaged = events.where("event_type = 'click'").select(F.lit('{"id": ').alias("value"), F.lit("2024-02-01").alias("updated_date"))
    first.unionByName(corrected).unionByName(damaged).write.partitionBy("updated_date").option("compression", "gzip").text(
        f"{base}/data/works"
    )
    load_snapshot(
        spark,
        base,
        "works",
        target=f"{base}/loaded",
        checkpoint=f"{base}/checkpoint",
        rejects=f"{base}/rejects",
        metrics=f"{base}/metrics",
    )
    raw = c("raw")
    return stored_documents(spark, f"{base}/loaded").select(
        "id",
        F.try_variant_get(raw, "$.event_type", "string").alias("event_type"),
        F.try_variant_get(raw, "$.value", "double").alias("value"),
        F.try_variant_get(raw, "$.fixed_by", "bigint").alias("fixed_by"),
    )
