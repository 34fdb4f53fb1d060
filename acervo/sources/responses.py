"""Landed API responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.functions.ids import record_key
from acervo.functions.nested import at, is_array, is_object, issn_list


def response_items(responses: DataFrame) -> DataFrame:
    """``(idx, item, hit)`` of ``(idx, status, body)`` rows.

    An object is the item, of a list its first element; anything else, an empty
    list and any status but 200 are misses.
    """
    body = F.try_parse_json("body")
    item = F.when(is_array(body), at(body, "$[0]", "variant")).when(is_object(body), body)
    return responses.select("idx", F.when(F.col("status") == 200, item).alias("item")).withColumn(
        "hit", F.col("item").isNotNull()
    )


def journal_records(items: DataFrame) -> DataFrame:
    """``(_id, raw, issns)`` of the hits: id, else codigo, else the running index."""
    hits = items.where("hit")
    return hits.select(
        record_key(at(F.col("item"), "$.id"), at(F.col("item"), "$.codigo"), F.col("idx").cast("string")).alias("_id"),
        F.col("item").alias("raw"),
        issn_list(F.col("item")).alias("issns"),
        "idx",
    )
