"""Workbook reader: one .xlsx file per task row, rows streamed out of the sheet."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.operators.headers import unique_headers
from acervo.session import materialise
from acervo.sources.paths import exists

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_OUT = "file_path string, row_number long, cells array<string>, reason string"
_BATCH = 2000
_TEXT, _VALUE, _ROW = f"{_MAIN}t", f"{_MAIN}v", f"{_MAIN}row"

# Built-in number formats that show a date or time.
_DATE_FORMATS = {*range(14, 23), *range(45, 48)}


def _column_index(ref: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]+", ref).group():
        n = n * 26 + ord(ch) - 64
    return n - 1


def _texts(element) -> str:
    if len(element) == 1 and len(element[0]) == 1 and not len(element[0][0]) and element[0][0].tag == _TEXT:
        return element[0][0].text or ""
    return "".join(t.text or "" for t in element.iter(f"{_MAIN}t"))


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Cell style numbers that format a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    dates = set(_DATE_FORMATS)
    for fmt in root.iter(f"{_MAIN}numFmt"):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", fmt.get("formatCode", ""))
        if re.search(r"[ymdhs]", code, re.IGNORECASE):
            dates.add(int(fmt.get("numFmtId")))
    styles = root.find(f"{_MAIN}cellXfs")
    if styles is None:
        return set()
    return {i for i, xf in enumerate(styles) if int(xf.get("numFmtId", 0)) in dates}


def _sheet_path(book: zipfile.ZipFile, sheet: str | None, active: bool) -> str:
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    sheets = list(root.find(f"{_MAIN}sheets"))
    at = 0
    if sheet is not None:
        names = [s.get("name") for s in sheets]
        if sheet not in names:
            raise ValueError(f"no sheet {sheet!r}")
        at = names.index(sheet)
    elif active:
        view = root.find(f"{_MAIN}bookViews/{_MAIN}workbookView")
        at = int(view.get("activeTab", 0)) if view is not None else 0
    rels = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    targets = {r.get("Id"): r.get("Target") for r in rels}
    target = targets[sheets[at].get(f"{_REL}id")]
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _cell(cell, shared: list[str], dates: set[int], typed: bool, days: dict[str, str]) -> object:
    """``days`` keeps the texts of dates that were met."""
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return _texts(cell)
    value = cell.findtext(_VALUE)
    if value is None:
        return None
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return value == "1" if typed else str(value == "1")
    if kind in ("str", "e"):
        return value
    if int(cell.get("s", 0)) in dates:
        text = days.get(value)
        if text is None:
            text = (datetime(1899, 12, 30) + timedelta(days=float(value))).isoformat(sep="T" if typed else " ")
            if len(days) < _BATCH:
                days[value] = text
        return text
    number = float(value)
    whole = number.is_integer() and "e" not in value and "E" not in value
    if typed:
        return int(number) if whole else number
    return str(int(number)) if whole else value


def _json(value: object) -> str:
    return repr(value) if type(value) is int else json.dumps(value)


def sheet_rows(content: bytes, sheet: str | None, active: bool, typed: bool) -> Iterator[list]:
    """Rows of a sheet as lists of cells, gaps filled with None.

    Untyped cells are texts; typed ones are JSON texts of their value.
    """
    book = zipfile.ZipFile(io.BytesIO(content))
    shared: list[str] = []
    if "xl/sharedStrings.xml" in book.namelist():
        for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")):
            shared.append(_texts(item))
    dates, days, columns = _date_styles(book), {}, {}
    with book.open(_sheet_path(book, sheet, active)) as xml:
        for _, row in ElementTree.iterparse(xml):
            if row.tag != _ROW:
                continue
            cells: list = []
            for cell in row:
                if ref := cell.get("r"):
                    letters = ref.rstrip("0123456789")
                    at = columns.get(letters)
                    if at is None:
                        at = columns[letters] = _column_index(ref)
                    if at > len(cells):
                        cells.extend([None] * (at - len(cells)))
                value = _cell(cell, shared, dates, typed, days)
                cells.append(value if value is None or not typed else _json(value))
            yield cells
            row.clear()


def _read_books(sheet: str | None, active: bool, typed: bool):
    def handed(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.list_(pa.string()), pa.string()), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in columns], ["file_path", "row_number", "cells", "reason"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                content = content.as_py()
                rows: list[tuple] = []
                try:
                    for n, cells in enumerate(sheet_rows(content, sheet, active, typed)):
                        rows.append((path, n - 1, cells, None))
                        if len(rows) == _BATCH:
                            yield handed(rows)
                            rows = []
                except Exception as problem:  # one bad workbook must not stop the others
                    rows.append((path, None, None, f"{type(problem).__name__}: {problem}"))
                if rows:
                    yield handed(rows)

    return read


def read_workbooks(
    spark: SparkSession, path: str, sheet: str | None = None, typed: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(rows of all workbooks, unreadable files).

    Each row has file_path, the 0-based row_number below the header, and
    ``values``: header to cell, as MAP<STRING,STRING>; typed cells are the JSON
    texts of their values. Short rows are padded with nulls and
    long ones cut to the header. All-null rows are dropped in the typed form.
    A workbook whose rows precede an error keeps them out: it is rejected whole.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.xls*")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "content")
    )
    # each workbook is opened once; header, rows and rejects then come from the written cells
    cells = materialise(files.mapInArrow(_read_books(sheet, typed, typed), _OUT), "workbook-cells")
    rejects = cells.where("reason is not null").select("file_path", "reason")
    whole = cells.where("reason is null").join(rejects.select("file_path"), "file_path", "left_anti")
    header_cells = F.col("cells")
    if typed:
        header_cells = F.transform(header_cells, lambda c: F.try_variant_get(F.try_parse_json(c), "$", "string"))
    headers = whole.where("row_number = -1").select("file_path", unique_headers(header_cells).alias("names"))
    width = F.size("names")
    padded = F.slice(
        F.concat("cells", F.array_repeat(F.lit(None).cast("string"), F.greatest(width - F.size("cells"), F.lit(0)))), 1, width
    )
    rows = (
        whole.where("row_number >= 0")
        .join(headers, "file_path")
        .select("file_path", "row_number", F.map_from_arrays("names", padded).alias("values"))
    )
    if typed:
        rows = rows.where(F.exists(F.map_values("values"), lambda v: v.isNotNull()))
    return rows, rejects


def as_variant(rows: DataFrame) -> DataFrame:
    """Typed workbook rows with ``raw``, an object of typed values."""
    parsed = F.transform_values("values", lambda _, v: F.try_parse_json(v))
    return rows.select("file_path", "row_number", F.to_variant_object(parsed).alias("raw"))


def workbook_columns(rows: DataFrame, names: list[str]) -> DataFrame:
    """Chosen headers as columns; a header a workbook lacks gives null."""
    return rows.select("file_path", "row_number", *[F.col("values")[n].alias(n) for n in names])


def workbook_dois(spark: SparkSession, path: str) -> DataFrame:
    """The ``doi`` column of the workbooks; none when the path does not exist."""
    if not exists(spark, path):
        return spark.createDataFrame([], "doi string")
    rows, _ = read_workbooks(spark, path)
    return rows.select(F.col("values")["doi"].alias("doi")).dropna()
