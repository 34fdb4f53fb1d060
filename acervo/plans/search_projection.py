"""Flat search table of works, written in key ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.functions.nested import kept_values, or_default
from acervo.functions.predicates import key_between
from acervo.functions.text import strip_markup

#: What one task sorts and one file holds, and what a row has beside its title.
RANGE_BYTES, ROW_BYTES = 128 << 20, 200


def search_documents(works: DataFrame) -> DataFrame:
    """One flat row per work with a title; absent texts become ``""``."""
    biblio = F.col("biblio")
    return works.where("title is not null").select(
        "id",
        strip_markup(F.col("title")).alias("title"),
        or_default(F.col("primary_location.source.display_name")).alias("source"),
        or_default(F.col("publication_year").cast("string")).alias("year"),
        *[or_default(biblio[c]).alias(c) for c in ("volume", "issue", "first_page", "last_page")],
        F.coalesce(
            kept_values(F.col("authorships"), lambda a: a["author"]["display_name"]),
            F.array().cast("array<string>"),
        ).alias("authors"),
    )


def untitled(works: DataFrame) -> DataFrame:
    return works.agg(F.count_if(F.col("title").isNull()).alias("untitled"))


def range_slice(works: DataFrame, key: str, min_id: str | int | None, max_id: str | int | None) -> DataFrame:
    """Rows of one half-open range, in key order inside each partition."""
    return works.where(key_between(F.col(key), min_id, max_id)).sortWithinPartitions(key)


def write_search_table(works: DataFrame, path: str, ranges: int) -> None:
    """Projection, range-partitioned by id so that a key lookup reads one file.

    There are ``ranges`` files, or as many more as keep each at about RANGE_BYTES.
    """
    size = works.where("title is not null").agg(F.coalesce(F.sum(F.octet_length("title") + ROW_BYTES), F.lit(0)).alias("size")).first()["size"]
    ranges = max(ranges, -(-size // RANGE_BYTES))
    (
        search_documents(works)
        .repartitionByRange(ranges, "id")
        .sortWithinPartitions("id")
        .write.mode("overwrite")
        .parquet(path)
    )
