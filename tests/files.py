"""Small input files for tests."""

from __future__ import annotations

import gzip
import json
import zipfile
from pathlib import Path
from xml.sax.saxutils import escape


def write_part(base: Path, entity: str, day: str, name: str, lines: list) -> Path:
    """One gzip NDJSON partition file; strings are written as they are."""
    folder = base / "data" / entity / f"updated_date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    with gzip.open(path, "wt", encoding="utf-8") as out:
        for line in lines:
            out.write((line if isinstance(line, str) else json.dumps(line, ensure_ascii=False)) + "\n")
    return path


def _cell(ref: str, value, shared: list[str]) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value}</v></c>'
    if value.startswith("date:"):
        return f'<c r="{ref}" s="1"><v>{value[5:]}</v></c>'
    if value.startswith("inline:"):
        return f'<c r="{ref}" t="inlineStr"><is><t>{escape(value[7:])}</t></is></c>'
    if value not in shared:
        shared.append(value)
    return f'<c r="{ref}" t="s"><v>{shared.index(value)}</v></c>'


def write_workbook(path: Path, sheets: dict[str, list[list]], active: int = 0) -> Path:
    """A minimal .xlsx; texts ``date:<n>`` become date cells, ``inline:<t>`` inline strings."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    shared: list[str] = []
    with zipfile.ZipFile(path, "w") as book:
        entries, rels = [], []
        for n, (name, table) in enumerate(sheets.items(), start=1):
            rows = "".join(
                f'<row r="{i}">{"".join(_cell(f"{chr(65 + j)}{i}", v, shared) for j, v in enumerate(row))}</row>'
                for i, row in enumerate(table, start=1)
            )
            book.writestr(f"xl/worksheets/sheet{n}.xml", f'<worksheet xmlns="{main}"><sheetData>{rows}</sheetData></worksheet>')
            entries.append(f'<sheet name="{name}" sheetId="{n}" r:id="rId{n}"/>')
            rels.append(f'<Relationship Id="rId{n}" Type="x" Target="worksheets/sheet{n}.xml"/>')
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{rel}"><bookViews><workbookView activeTab="{active}"/></bookViews>'
            f'<sheets>{"".join(entries)}</sheets></workbook>',
        )
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships>{"".join(rels)}</Relationships>')
        items = "".join(f"<si><t>{escape(t)}</t></si>" for t in shared)
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{items}</sst>')
        book.writestr(
            "xl/styles.xml",
            f'<styleSheet xmlns="{main}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        )
    return path
