"""Record identifiers and digests."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acervo.functions.nested import first_nonblank


def row_id(*parts: Column) -> Column:
    return F.concat_ws(":", *parts)


def _prefixed(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value)


def article_id(doi: Column, record_id: Column, digest: Column) -> Column:
    """``doi:``, else ``doaj:``, else ``hash:``."""
    return F.coalesce(
        _prefixed("doi:", F.lower(first_nonblank(doi))),
        _prefixed("doaj:", first_nonblank(record_id)),
        _prefixed("hash:", digest),
    )


def journal_id(record_id: Column, print_issn: Column, e_issn: Column, issns: Column, digest: Column) -> Column:
    """``doaj:``, else ``issn:`` with the known numbers joined by a pipe, else ``hash:``."""
    known = F.filter(
        F.concat(F.array(print_issn, e_issn), F.coalesce(issns, F.array().cast("array<string>"))),
        lambda x: x.isNotNull() & (x != ""),
    )
    return F.coalesce(
        _prefixed("doaj:", first_nonblank(record_id)),
        F.when(F.size(known) > 0, _prefixed("issn:", F.array_join(known, "|"))),
        _prefixed("hash:", digest),
    )


def record_key(identifier: Column, code: Column, position: Column) -> Column:
    """First of the three that is not null. Zero and empty text are kept."""
    return F.coalesce(identifier, code, position)


@F.pandas_udf(T.StringType())
def canonical_sha1(documents: pd.Series) -> pd.Series:
    """SHA-1 of the JSON text with sorted keys, ``", "``/``": "`` separators and ASCII escapes."""

    def digest(text: str) -> str:
        canonical = json.dumps(json.loads(text), sort_keys=True)
        return hashlib.sha1(canonical.encode()).hexdigest()

    return documents.map(digest, na_action="ignore")


def content_matches(content: Column, checksum: Column, size: Column) -> Column:
    """Whether a file equals its announced checksum (text after the last colon),
    or, when none is announced, its size. No announcement means no match."""
    expected = F.element_at(F.split(checksum, ":"), -1)
    return F.coalesce(
        F.when(F.nullif(checksum, F.lit("")).isNotNull(), F.sha2(content, 256) == expected),
        F.octet_length(content) == size,
        F.lit(False),
    )
