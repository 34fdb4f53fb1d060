"""JSON files holding one list: plain, gzip or zip."""

from __future__ import annotations

import gzip
import io
import json
import re
import zipfile
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.session import materialise

# Fixed value: the member to take from an archive.
MEMBER = r"ror-data\.json$"

#: Characters read at a time, and records handed on at a time.
CHUNK, ROWS = 1 << 20, 500


def _no_constant(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


class _Reader:
    """A window on a JSON text that moves forward and holds one value at a time."""

    def __init__(self, source: io.TextIOBase) -> None:
        self.source, self.text, self.at, self.step = source, "", 0, CHUNK
        self.decoder = json.JSONDecoder(parse_constant=_no_constant)

    def more(self) -> bool:
        piece = self.source.read(self.step)
        self.text, self.at = self.text[self.at :] + piece, 0
        # a value longer than the window is tried again only after the window has doubled
        self.step = max(CHUNK, len(self.text))
        return bool(piece)

    def peek(self) -> str:
        """The next character that is no white space; empty at the end."""
        while True:
            while self.at < len(self.text) and self.text[self.at] in " \t\r\n":
                self.at += 1
            if self.at < len(self.text) or not self.more():
                return self.text[self.at : self.at + 1]

    def skip(self, expected: str) -> None:
        if self.peek() != expected:
            raise ValueError(f"{expected!r} is missing")
        self.at += 1

    def value(self) -> str:
        """The text of the next value."""
        self.peek()
        while True:
            try:
                _, end = self.decoder.raw_decode(self.text, self.at)
                # a number may go on beyond the window
                if end < len(self.text) or not self.more():
                    break
            except ValueError:
                if not self.more():
                    raise
        found, self.at, self.step = self.text[self.at : end], end, CHUNK
        return found

    def elements(self) -> Iterator[str]:
        self.skip("[")
        if self.peek() == "]":
            self.at += 1
            return
        while True:
            yield self.value()
            if self.peek() == "]":
                self.at += 1
                return
            self.skip(",")


def _shape(reader: _Reader) -> bool:
    """Whether an object has a list of items; checks that the whole text is one JSON value."""
    listed = False
    if reader.peek() == "{":
        reader.skip("{")
        while reader.peek() != "}":
            key = json.loads(reader.value())
            if not isinstance(key, str):
                raise ValueError("a key is no string")
            reader.skip(":")
            if key == "items":
                listed = reader.peek() == "["
            if reader.peek() == "[":
                for _ in reader.elements():
                    pass
            else:
                reader.value()
            if reader.peek() != "}":
                reader.skip(",")
        reader.skip("}")
    elif reader.peek() == "[":
        for _ in reader.elements():
            pass
    else:
        raise ValueError("no list and no object")
    if reader.peek():
        raise ValueError("text after the end")
    return listed


def _records(reader: _Reader, listed: bool) -> Iterator[str]:
    if reader.peek() == "[":
        yield from reader.elements()
    elif not listed:
        yield reader.value()
    else:
        reader.skip("{")
        while True:
            key = json.loads(reader.value())
            reader.skip(":")
            if key == "items" and reader.peek() == "[":
                yield from reader.elements()
                return
            reader.value()
            reader.skip(",")


def _open(path: str, content: bytes) -> io.TextIOBase | None:
    """The JSON text as a stream; packed content is unpacked as it is read."""
    if path.lower().endswith(".zip"):
        book = zipfile.ZipFile(io.BytesIO(content))
        names = [n for n in book.namelist() if re.search(MEMBER, n, re.IGNORECASE)]
        names = names or [n for n in book.namelist() if n.lower().endswith(".json")]
        if not names:
            return None
        raw = book.open(names[-1])
    else:
        raw = gzip.open(io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    return io.TextIOWrapper(raw, encoding="utf-8-sig")


def _split_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A file is read twice: once to see that it is whole and what shape it has, once for its records."""
    columns = ["file_path", "position", "record", "reason"]
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            try:
                source = _open(path, content)
                if source is None:
                    raise ValueError("no member")
                listed = _shape(_Reader(source))
            except (ValueError, OSError, EOFError, zipfile.BadZipFile):
                yield pd.DataFrame([(path, 0, None, "bad_json")], columns=columns)
                continue
            rows = ((path, n, record, None) for n, record in enumerate(_records(_Reader(_open(path, content)), listed)))
            while chunk := list(islice(rows, ROWS)):
                yield pd.DataFrame(chunk, columns=columns)


def read_wrapped(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(documents as ``raw`` VARIANT, files whose text is no list and no object).

    Each file is cut into its records by one task that holds one record at a time beside the packed
    bytes, so a list may be longer than a VARIANT. A single record that no VARIANT can hold is a reject of its own.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    parsed = files.mapInPandas(_split_files, "file_path string, position long, record string, reason string")
    # each file is cut once; records and rejects then come from what is written
    read = materialise(parsed.select("file_path", "position", F.try_parse_json("record").alias("raw"), "reason"), "wrapped-records")
    good = read.where("raw is not null").select("file_path", F.col("position").cast("int").alias("position"), "raw")
    rejects = read.where("raw is null").select("file_path", F.coalesce("reason", F.lit("bad_record")).alias("reason"))
    return good, rejects
