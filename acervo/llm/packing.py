"""Pack documents into sequences of bounded length by cutting-stock column generation."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acervo.llm.arrow import slices
from acervo.llm.tokens import BYTE_BPE, byte_encoder, kept_by_worker
from acervo.session import materialise

LENGTH = 2048
#: Id that ends a document.
END = 1
#: Tokens of one step of the length histogram: lengths count as the next multiple.
STEP = 16
#: Pieces that are ranked together within a length class.
RANK_ROWS = 16_384
#: Columns generated at most; the packing is complete after any number, only tighter after more.
ROUNDS = 3000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces_of(docs: DataFrame, length: int = LENGTH, tokenizer: str = BYTE_BPE, end: int = END, with_ids: bool = False) -> DataFrame:
    """``PIECES`` (and ``ids``): every document cut into whole sequences and one rest. A null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept_by_worker(("bytes", tokenizer), lambda: byte_encoder(tokenizer))
        for batch in slices(batches):
            rows: list[tuple] = []
            ids_of: list[np.ndarray] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), end], np.uint32)
                for at in range(0, len(ids), length):
                    part = ids[at : at + length]
                    rows.append((doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids)))
                    if with_ids:
                        ids_of.append(part)
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 5
            names = [c.split()[0] for c in PIECES.split(", ")]
            if with_ids:
                columns.append(pa.array([i.astype(np.int32) for i in ids_of], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES + ", ids array<int>" * with_ids)


def best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits, by dynamic programming over the capacity."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        n = np.searchsorted(sizes, room, "right")
        best[room] = best[room - 1]
        if n:
            with_one = values[:n] + best[room - sizes[:n]]
            k = int(with_one.argmax())
            if with_one[k] > best[room] + 1e-12:
                best[room], took[room] = with_one[k], k
    pattern = np.zeros(len(sizes))
    room = capacity
    while room > 0:
        if took[room] < 0:
            room -= 1
        else:
            pattern[took[room]] += 1
            room -= sizes[took[room]]
    return float(best[capacity]), pattern


def cutting_patterns(counts: np.ndarray, sizes: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[np.ndarray, int]]:
    """``(pattern, repeats)``: how many items of each size go into a sequence; together exactly ``counts``.

    The linear program of the fewest sequences is solved by the revised simplex method. Its columns, the patterns, are made
    when needed: the one of most value at the current prices of the sizes enters while it is worth more than a sequence. The solution
    is rounded down; what is left, a few items for each pattern, is packed largest first.
    """
    use = counts > 0
    counts, sizes = counts[use].astype(float), sizes[use]
    m = len(sizes)
    whole: list[tuple[np.ndarray, int]] = []

    def spread(pattern: np.ndarray) -> np.ndarray:
        full = np.zeros(len(use), np.int64)
        full[use] = pattern
        return full

    if not m:
        return whole
    copies = (capacity // sizes).astype(float)
    basis = np.diag(copies)
    inverse = np.diag(1 / copies)
    amount = counts / copies
    for _ in range(rounds):
        prices = inverse.sum(0)
        value, column = best_pattern(prices, sizes, capacity)
        if value <= 1 + 1e-7:
            break
        change = inverse @ column
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(change > 1e-9, amount / change, np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        if not np.isfinite(step):
            break
        amount = np.maximum(amount - step * change, 0)
        amount[out] = step
        basis[:, out] = column
        inverse[out] /= change[out]
        others = np.arange(m) != out
        inverse[others] -= np.outer(change[others], inverse[out])
    left = counts.astype(np.int64)
    for k in np.argsort(-amount):
        column = basis[:, k].astype(np.int64)
        has = column > 0
        # rounding errors must not take more than is there
        n = min(int(amount[k] + 1e-6), int((left[has] // column[has]).min()))
        if n > 0:
            whole.append((spread(column), n))
            left -= n * column
    while left.any():
        column, room = np.zeros(m, np.int64), capacity
        for k in range(m - 1, -1, -1):
            n = min(left[k] - column[k], room // sizes[k])
            column[k] += n
            room -= n * sizes[k]
        has = column > 0
        n = int((left[has] // column[has]).min())
        whole.append((spread(column), n))
        left -= n * column
    return whole


def pack(docs: DataFrame, length: int = LENGTH, tokenizer: str = BYTE_BPE, end: int = END, step: int = STEP, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place: ``PIECES, sequence_id, offset`` (and ``ids``).

    A document fills whole sequences first; its rest counts in a histogram of lengths, whose size depends on ``length`` and
    ``step`` only. The patterns that pack the histogram are found on the driver, and the pieces of a length class, ranked by all
    executors, are dealt to the patterns that ask for that class. Offsets inside a sequence have no gaps; what is left at its end is padding.

    A null text is an empty one and holds the end id alone. Every row is packed, also repeated ones and those without an id.
    Other columns are ignored.
    """
    cut = materialise(pieces_of(docs, length, tokenizer, end, with_ids).withColumn("size", F.ceil(F.col("length") / step).cast("int")), "pack-pieces")
    top = -(-length // step)
    full = F.col("length") == length
    sized = cut.withColumn("size", F.when(full, F.lit(top + 1)).otherwise(F.col("size")))
    histogram = np.zeros(top + 2, np.int64)
    for row in sized.groupBy("size").count().collect():
        histogram[row["size"]] = row["count"]
    patterns = cutting_patterns(histogram[: top + 1], np.arange(top + 1), length // step)
    #: Ranges of ranks of each class, in order: (first rank, items of the class in the pattern, first sequence, items before them).
    ranges: list[list[tuple[int, int, int, int]]] = [[] for _ in range(top + 2)]
    dealt = np.zeros(top + 2, np.int64)
    sequence = 0
    for column, n in patterns:
        before = 0
        for k in np.flatnonzero(column).tolist():
            ranges[k].append((int(dealt[k]), int(column[k]), sequence, before))
            dealt[k] += column[k] * n
            before += int(column[k])
        sequence += n
    ranges[top + 1].append((0, 1, sequence, 0))
    tables = [np.array(r, np.int64).reshape(-1, 4) for r in ranges]
    buckets = F.element_at(F.array(*[F.lit(max(1, -(-int(c) // RANK_ROWS))) for c in histogram]), F.col("size") + 1)
    order = ["doc_id", "start", "ids_crc32"]
    kept = [*[c.split()[0] for c in PIECES.split(", ")], *["ids"] * with_ids]
    bucketed = sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), buckets).cast("long"))
    sums = bucketed.groupBy("size", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = sums.select(
        F.col("size").alias("_size"), F.col("bucket").alias("_bucket"),
        F.coalesce(F.sum("n").over(W.partitionBy("size").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("first"),
    )
    ranked = bucketed.withColumn("nth", F.row_number().over(W.partitionBy("size", "bucket").orderBy(*order)))
    ranked = ranked.join(before, (F.col("size") == F.col("_size")) & (F.col("bucket") == F.col("_bucket"))).withColumn("rank", F.col("first") + F.col("nth") - 1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = batch.column("size").to_numpy(), batch.column("rank").to_numpy()
            at, slot = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for k in np.unique(size).tolist():
                rows = size == k
                table = tables[k]
                r = table[np.searchsorted(table[:, 0], rank[rows], "right") - 1]
                past = rank[rows] - r[:, 0]
                at[rows] = r[:, 2] + past // r[:, 1]
                slot[rows] = r[:, 3] + past % r[:, 1]
            yield batch.select(kept).append_column("sequence_id", pa.array(at)).append_column("slot", pa.array(slot))

    schema = PIECES + ", ids array<int>" * with_ids + ", sequence_id long, slot long"
    placed = ranked.select(*kept, "size", "rank").mapInArrow(deal, schema)
    inside = W.partitionBy("sequence_id").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long")).drop("slot")


def sequences(packed: DataFrame, length: int = LENGTH, pad: int = 0) -> DataFrame:
    """``sequence_id, n_tokens, ids``: the sequences of ``pack(..., with_ids=True)``, padded unless at a power of two."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
    ids = F.flatten(F.transform("parts", lambda p: p["ids"]))
    power = F.expr("n_tokens & (n_tokens - 1)") == 0
    filled = F.when(power, ids).otherwise(F.concat(ids, F.array_repeat(F.lit(pad), (length - F.col("n_tokens")).cast("int"))))
    return joined.select("sequence_id", "n_tokens", filled.alias("ids"))
