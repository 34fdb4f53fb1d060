"""Lineage columns of rows that come from a listed file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.functions.ids import row_id


def with_lineage(rows: DataFrame, file: DataFrame, file_key: str, extracted_at: Column) -> DataFrame:
    """Add the file's institution and listing columns, a row id and the run time.

    ``rows`` carries ``row_number`` (0-based, in file order) and ``file_key``;
    ``file`` has one row per file with institution_id, institution_name,
    folder_id, file_id, file_name, modified_time and file_size.
    """
    return rows.join(file, file_key).withColumns(
        {
            "_id": row_id(F.col("institution_id"), F.col("file_id"), F.col("row_number")),
            "extracted_at": extracted_at,
        }
    )
