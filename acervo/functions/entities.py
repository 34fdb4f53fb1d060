"""HTML character references decoded inside the JVM, by the rules of the HTML standard.

The name table is the one Python ships; it travels as one literal.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

_REPLACEMENT = "\ufffd"
_PIECES = r"(?s)&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&"
_ITEM, _PAIR = "\ue000", "\ue001"  # private-use letters, in no name or value

# names that are also valid without a semicolon, longest first
_OPEN_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)


def _windows_letter(n: int) -> str:
    """C1 numbers mean the Windows-1252 letter; undefined ones stay."""
    try:
        return bytes([n]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(n)


def _map(entries: dict[str, str]) -> Column:
    text = _ITEM.join(f"{k}{_PAIR}{v}" for k, v in entries.items())
    return F.str_to_map(F.lit(text), F.lit(_ITEM), F.lit(_PAIR))


def _numbered(piece: Column) -> Column:
    decimal = F.regexp_extract(piece, r"^&#([0-9]+)", 1)
    hexadecimal = F.regexp_extract(piece, r"^&#[xX]([0-9a-fA-F]+)", 1)
    # more digits than any character number has: out of range
    number = F.coalesce(
        F.when(F.length(F.ltrim(decimal, F.lit("0"))) <= 10, decimal.try_cast("bigint")),
        F.when(
            (hexadecimal != "") & (F.length(F.ltrim(hexadecimal, F.lit("0"))) <= 8),
            F.conv(hexadecimal, 16, 10).try_cast("bigint"),
        ),
    )
    replaced = {"0": _REPLACEMENT, "13": "\r", **{str(n): _windows_letter(n) for n in range(0x80, 0xA0)}}
    plane_end = F.pmod(number, F.lit(0x10000)) >= 0xFFFE
    dropped = (
        number.between(1, 8) | (number == 11) | number.between(14, 31) | (number == 127) | number.between(0xFDD0, 0xFDEF) | plane_end
    )
    letter = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return (
        F.when(number.isNull() | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF), _REPLACEMENT)
        .when(F.map_contains_key(_map(replaced), number.cast("string")), F.try_element_at(_map(replaced), number.cast("string")))
        .when(dropped, "")
        .otherwise(letter)
    )


def _named(piece: Column) -> Column:
    names = _map(html5)
    start = F.regexp_extract(piece, f"^&({'|'.join(_OPEN_NAMES)})", 1)
    opened = F.concat(F.try_element_at(names, start), F.substring(piece, F.length(start) + 2, F.length(piece)))
    return F.coalesce(F.try_element_at(names, F.substring(piece, F.lit(2), F.length(piece))), opened, piece)


def _decoded(text: Column) -> Column:
    pieces = F.transform(
        F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0)),
        lambda p: F.when(p.startswith("&#"), _numbered(p)).when(p.startswith("&") & (p != "&"), _named(p)).otherwise(p),
    )
    return F.when(text.contains("&"), F.array_join(pieces, "")).otherwise(text)


def decode_entities(value: Column) -> Column:
    """Character references to characters; texts without an ampersand are not touched."""
    # bound to a name, so that a costly input expression runs once
    return F.get(F.transform(F.array(value), _decoded), F.lit(0))
