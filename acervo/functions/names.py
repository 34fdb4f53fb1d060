"""Names that carry fields: institution folders, dated matrices, periods, stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from acervo.functions.text import file_stem, strip_text

# The shape of a dated matrix name and its two date layouts.
MATRIX_NAME = (
    r"(?i)^ciarp_([^_]+)_"
    r"(\d{2}_\d{2}_\d{4}_\d{2}:\d{2}|\d{4}-\d{2}-\d{2}_\d{2}:\d{2})(?:_.*)?$"
)
MATRIX_DATE_LAYOUTS = ("dd_MM_yyyy_HH:mm", "yyyy-MM-dd_HH:mm")


def folder_institution(name: Column) -> Column:
    """Id before the first underscore; null when the name has none."""
    return F.when(F.instr(name, "_") > 0, strip_text(F.substring_index(name, "_", 1)))


def folder_label(name: Column) -> Column:
    """Text after the first underscore, or the whole name when there is none."""
    rest = F.substring(name, F.instr(name, "_") + 1, F.length(name))
    return F.when(F.instr(name, "_") > 0, strip_text(rest)).otherwise(name)


def parse_timestamp(text: Column, layouts: tuple[str, ...]) -> Column:
    """First layout that fits, null when none does."""
    return F.coalesce(
        *[F.try_to_timestamp(text, F.lit(p)).cast("timestamp_ntz") for p in layouts]
    )


def _matrix_group(file_name: Column, group: int) -> Column:
    text = F.regexp_extract(file_stem(file_name), MATRIX_NAME, group)
    return F.when(text != "", strip_text(text))


def matrix_institution(file_name: Column) -> Column:
    return _matrix_group(file_name, 1)


def matrix_date_text(file_name: Column) -> Column:
    return _matrix_group(file_name, 2)


def matrix_date(file_name: Column) -> Column:
    return parse_timestamp(matrix_date_text(file_name), MATRIX_DATE_LAYOUTS)


def semester(day: Column) -> Column:
    return F.when(F.month(day) <= 6, 1).otherwise(2)


def period_name(prefix: str, day: Column) -> Column:
    """Namespace of a capture period, for example ``journals_2026_1``."""
    return F.concat_ws("_", F.lit(prefix), F.year(day), semester(day))


def stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def month_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMM")


def iso_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
