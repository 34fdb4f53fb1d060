"""Remove passages of three lines and more that occurred before, anywhere in the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lines of one window.
WINDOW = 3


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def window_hashes(lines: Column, window: int = WINDOW) -> Column:
    """``(start, hash)`` of every window of consecutive lines that holds a word; 128 bits of the joined lines."""
    starts = F.when(F.size(lines) >= window, F.sequence(F.lit(1), F.size(lines) - (window - 1))).otherwise(F.array().cast("array<int>"))
    joined = F.transform(starts, lambda i: F.struct(i.alias("start"), F.array_join(F.slice(lines, i, window), "\n").alias("body")))
    worded = F.filter(joined, lambda w: w["body"].rlike(r"[^\x20\x09-\x0D]"))
    return F.transform(worded, lambda w: F.struct(w["start"].alias("start"), F.unhex(F.md5(w["body"])).alias("hash")))


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, text_hash, starts``: the sorted starts of the windows of a document that occurred before.

    Order of occurrence is that of (doc_id, place in the text); documents without an id come last, texts of one id in the
    order of their hash. Rows equal in id and text are one document.
    """
    spots = docs.where(F.col("text").isNotNull()).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.explode(window_hashes(lines_of(F.col("text")), window)).alias("w")
    )
    spots = spots.select("doc_id", "text_hash", F.col("w.start").alias("start"), F.col("w.hash").alias("hash"))
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash", "start")
    #: One row per window that occurs at more than one place: its first place.
    first = spots.groupBy("hash").agg(F.min(order).alias("first"), F.max(order).alias("last")).where(~F.col("first").eqNullSafe(F.col("last"))).select("hash", "first")
    later = spots.join(first, "hash").where(order > F.col("first"))
    # as many starts as the document has lines
    return later.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("start")).alias("starts"))


def dedup_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without later occurrences of passages of ``window`` lines and more; adds ``n_lines`` and ``n_removed``.

    Every window of consecutive lines is hashed; of a window that occurs at several places, also within a document,
    all but the first are covered, and covered lines go. Covered windows that overlap or touch merge into one passage.
    Lines are compared as they are, blank ones included; a window without any word never counts. A document
    of fewer lines than a window is left alone, a null text stays null with no lines, other columns
    are carried through (but for columns already named n_lines or n_removed, which are replaced).
    """
    kept_columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    found = repeated_windows(docs, window).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("starts").alias("_starts"))
    met = docs.join(found, (F.xxhash64(docs["text"]) == found["_hash"]) & docs["doc_id"].eqNullSafe(found["_id"]), "left")
    lines = lines_of(docs["text"])
    starts = found["_starts"]
    #: The uncovered lines between one covered window and the next, by (first, number).
    gaps = F.transform(
        F.sequence(F.lit(0), F.size(starts)),
        lambda i: F.struct(
            F.when(i == 0, F.lit(1)).otherwise(F.get(starts, i - 1) + window).alias("first"),
            F.when(i == F.size(starts), F.size(lines) + 1).otherwise(F.get(starts, i)).alias("until"),
        ),
    )
    open_gaps = F.filter(gaps, lambda g: g["until"] > g["first"])
    kept = F.flatten(F.transform(open_gaps, lambda g: F.slice(lines, g["first"], g["until"] - g["first"])))
    n_lines = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    n_kept = F.aggregate(open_gaps, F.lit(0), lambda n, g: n + g["until"] - g["first"])
    columns = {c: docs[c] for c in kept_columns} | {"text": F.when(starts.isNull(), docs["text"]).otherwise(F.array_join(kept, "\n"))}
    return met.select(
        *[v.alias(c) for c, v in columns.items()],
        F.when(docs["text"].isNull(), F.lit(0)).otherwise(n_lines).cast("long").alias("n_lines"),
        F.when(starts.isNull(), F.lit(0)).otherwise(F.size(lines) - n_kept).cast("long").alias("n_removed"),
    )
