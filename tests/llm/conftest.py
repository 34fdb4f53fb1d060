from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
        # names that operators use themselves
        *[T.StructField(n, T.StringType()) for n in ("size", "fp", "start", "rank", "taken", "n_lines", "kept", "n_words", "hash", "score", "part", "node", "word",
                                                              "row", "id", "words", "of", "gone", "twice", "_text", "_count_n_words", "_of", "_gone", "_node", "_twice", "nth")],
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """``make(rows)``: a documents table from (doc_id, text, source) rows, with extra columns of clashing names."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", s, len(t or ""), *["x"] * (len(DOCS) - 5)) for i, t, s in rows], DOCS)

    return make


LONG = " ".join(f"w{i % 977}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd(documents):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    return documents(
        [
            (1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (None, "one two three", "b"), (None, None, None), (5, "one two three", None),
            (6, "é ü 漢字 \U0001f600", "ü"), (6, "é ü 漢字 \U0001f600", "ü"), (7, LONG, "a"), (8, LONG, "b"), (9, LONG + " end", "a"),
            (10, "x\ny\nz\n\n\nx\ny\nz", "c"), (11, "x\ny\nz", "c"), (11, "other text", "c"), (-4, "neg", "d"),
        ]
    )


@pytest.fixture(scope="session")
def empty(documents):
    return documents([])
