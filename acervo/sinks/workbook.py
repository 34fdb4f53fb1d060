"""Workbook writer: every task writes its rows as .xlsx files of a bounded number of rows."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence
from datetime import date, datetime
from itertools import chain
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.session import materialise

#: Rows of one workbook; a sheet holds about a million.
BOOK_ROWS = 20_000
_WRITTEN = "file_path string, n_rows long"
# Name spaces of the format.
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def _column_name(at: int) -> str:
    name, at = "", at + 1
    while at:
        at, rest = divmod(at - 1, 26)
        name = chr(65 + rest) + name
    return name


def _escaped(text: str) -> str:
    if "&" in text or "<" in text or ">" in text or "\r" in text:
        return escape(text, {chr(13): "&#13;"})
    return text


def _cell(ref: str, value: object) -> str:
    """A null is no cell, dates and times are day numbers in a date style, texts are inline."""
    if value is None:
        return ""
    if isinstance(value, str):
        return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{_escaped(value)}</t></is></c>'
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, date):
        moment = value if isinstance(value, datetime) else datetime(value.year, value.month, value.day)
        gap = moment - datetime(1899, 12, 30)
        return f'<c r="{ref}" s="1"><v>{gap.days + (gap.seconds + gap.microseconds / 1e6) / 86400!r}</v></c>'
    if isinstance(value, int | float):
        return f'<c r="{ref}"><v>{value!r}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{_escaped(str(value))}</t></is></c>'


def sheet_xml(header: Sequence[str], rows: Iterator[Sequence[object]]) -> Iterator[str]:
    yield f'<worksheet xmlns="{_MAIN}"><sheetData>'
    names: list[str] = []
    for n, row in enumerate(chain([header], rows), 1):
        names.extend(map(_column_name, range(len(names), len(row))))
        yield f'<row r="{n}">' + "".join([_cell(f"{name}{n}", value) for name, value in zip(names, row, strict=False)]) + "</row>"
    yield "</sheetData></worksheet>"


def workbook_bytes(sheets: dict[str, tuple[Sequence[str], list[Sequence[object]]]], active: int = 0) -> bytes:
    """An .xlsx file of named sheets, each a header and rows."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as book:
        entries, links = [], []
        for n, (name, (header, rows)) in enumerate(sheets.items(), 1):
            book.writestr(f"xl/worksheets/sheet{n}.xml", "".join(sheet_xml(header, rows)))
            entries.append(f'<sheet name={quoteattr(name)} sheetId="{n}" r:id="rId{n}"/>')
            links.append(f'<Relationship Id="rId{n}" Type="{_REL}/worksheet" Target="worksheets/sheet{n}.xml"/>')
        views = f'<bookViews><workbookView activeTab="{active}"/></bookViews>'
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}">{views}<sheets>{"".join(entries)}</sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}">{"".join(links)}</Relationships>')
        book.writestr("xl/styles.xml", f'<styleSheet xmlns="{_MAIN}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
    return out.getvalue()


def write_workbooks(rows: DataFrame, folder: str, header: Sequence[str] | None = None, sheet: str = "rows", cover: str | None = None, most: int = BOOK_ROWS) -> DataFrame:
    """Write ``rows`` under ``folder`` and return what was written: ``file_path, n_rows``.

    Nothing moves: a task writes its rows as they come, ``most`` to a workbook, on ``sheet``, under ``header`` or the names of
    the columns. A ``cover`` is an empty first sheet before it; the sheet of the rows is the active one. A task
    that runs again writes the same files anew. A character that XML cannot hold makes the workbook unreadable.
    """
    names = list(header or rows.columns)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        task, held, n = TaskContext.get().partitionId(), [], 0

        def close() -> pa.RecordBatch:
            sheets = {cover: ([], [])} if cover else {}
            content = workbook_bytes(sheets | {sheet: (names, held)}, len(sheets))
            path = f"{root.rstrip('/')}/part-{task:05d}-{n:05d}.xlsx"
            with store.open_output_stream(path) as out:
                out.write(content)
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(held)], pa.int64())], ["file_path", "n_rows"])

        for batch in batches:
            for row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                held.append(row)
                if len(held) == most:
                    yield close()
                    held, n = [], n + 1
        if held:
            yield close()

    # by place: names may repeat or hold dots
    numbered = rows.toDF(*[f"c{n}" for n in range(len(names))])
    plain = numbered.select(*[F.col(name).cast("double") if kind.startswith("decimal") else F.col(name) for name, kind in numbered.dtypes])
    return materialise(plain.mapInArrow(write, _WRITTEN), "written-workbooks")
