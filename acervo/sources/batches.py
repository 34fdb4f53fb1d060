"""JSON batch files whose shape is only known by reading them."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Batch name prefixes, and the keys that wrap a list of records.
PREFIXES = {"journal": "journal_batch_", "article": "article_batch_"}
ENVELOPE_KEYS = ("results", "items", "data", "records")

_BATCH = 2000
_OUT = "file_path string, position long, record string, reason string"


def _unwrap(value: object) -> Iterator[dict]:
    if isinstance(value, dict):
        wrapped = next((value[k] for k in ENVELOPE_KEYS if isinstance(value.get(k), list)), None)
        if wrapped is None:
            yield value
            return
        value = wrapped
    if isinstance(value, list):
        yield from (item for item in value if isinstance(item, dict))


def _no_constant(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


def _strict(text: str) -> object:
    return json.loads(text, parse_constant=_no_constant)


def _loads(text: str) -> object:
    """Parsed JSON, or None: a line that is JSON null is no record either."""
    try:
        return _strict(text)
    except ValueError:
        return None


def records_of(text: str) -> Iterator[tuple[dict | None, str | None]]:
    """Records of one batch file, and what was lost: (record, None) or (None, reason).

    The first two non-blank lines decide. An object with an envelope key on
    line one stands for the whole file. Two objects mean NDJSON, which ends at its
    first bad line. One object followed by anything else is a single record.
    Everything else is read as one JSON text.
    """
    lines = [line for line in re.split(r"\r\n|\r|\n", text) if line.strip()]
    first = _loads(lines[0]) if lines else None
    if not isinstance(first, dict):
        try:
            yield from ((r, None) for r in _unwrap(_strict(text)))
        except ValueError:
            yield None, "bad_json"
        return
    if any(k in first for k in ENVELOPE_KEYS):
        yield from ((r, None) for r in _unwrap(first))
        lost = len(lines) - 1
    elif len(lines) == 1 or not isinstance(_loads(lines[1]), dict):
        yield first, None
        lost = len(lines) - 1
    else:
        lost = 0
        for n, line in enumerate(lines):
            try:
                item = _strict(line)
            except ValueError:
                lost = len(lines) - n
                break
            if isinstance(item, dict):
                yield item, None
    for _ in range(lost):
        yield None, "after_end_of_records"


def _parse_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, text in zip(batch["file_path"], batch["value"], strict=True):
            rows = (
                (path, n, None if record is None else json.dumps(record), reason)
                for n, (record, reason) in enumerate(records_of(text))
            )
            while chunk := list(islice(rows, _BATCH)):
                yield pd.DataFrame(chunk, columns=["file_path", "position", "record", "reason"])


def read_json_batches(spark: SparkSession, path: str, dump_type: str) -> tuple[DataFrame, DataFrame]:
    """(records as ``raw`` VARIANT with file and position, rejects with their number)."""
    files = (
        spark.read.option("pathGlobFilter", f"{PREFIXES[dump_type]}*.json")
        .option("recursiveFileLookup", "true")
        .text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("file_path"), "value")
    )
    # escapes stay escapes, so one odd value is a reject of its own and does not stop the load
    parsed = files.mapInPandas(_parse_files, _OUT).withColumn("raw", F.try_parse_json("record"))
    parsed = parsed.withColumn("reason", F.when(F.col("reason").isNull() & F.col("raw").isNull(), "bad_record").otherwise(F.col("reason")))
    good = parsed.where("reason is null").select("file_path", "position", "raw")
    rejects = parsed.where("reason is not null").groupBy("file_path", "reason").agg(F.count("*").alias("lines"))
    return good, rejects
