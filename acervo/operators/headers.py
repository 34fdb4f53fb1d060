"""Workbook header repair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def named_headers(cells: Column) -> Column:
    """Blank header cells become ``column_<n>``, n being their 1-based position."""
    return F.transform(
        cells,
        lambda c, i: F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.concat(F.lit("column_"), i + 1)).otherwise(c),
    )


def unique_headers(cells: Column) -> Column:
    """Headers with repeats numbered ``_2``, ``_3``, passing over names already taken.

    A fold over one header row; the workbook format bounds it to 16,384 cells.
    """

    def add(taken: Column, name: Column) -> Column:
        numbered = F.transform(F.sequence(F.lit(2), F.size(taken) + 2), lambda i: F.concat(name, F.lit("_"), i))
        free = F.get(F.filter(numbered, lambda c: ~F.array_contains(taken, c)), F.lit(0))
        return F.array_append(taken, F.when(F.array_contains(taken, name), free).otherwise(name))

    return F.aggregate(named_headers(cells), F.array().cast("array<string>"), add)
