"""Token ids as compressed binary: an adaptive context-mixing range coder over independent, checksummed blocks.

A segment is one binary value: a header, an index of documents, the order-0 table and the blocks. Blocks of a segment share the table
only; each starts with an empty adaptive model and is decoded and verified by itself. All blocks of a segment are coded
side by side, one token of each at a time, so that numpy does the arithmetic of hundreds of coders in one call.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acervo.llm.tokens import WORD_BPE, WordEncoder, kept_by_worker
from acervo.session import scratch_path

MAGIC = b"ACTK1\n"
END = 2
#: Tokens of a block, and blocks coded side by side; a segment closes after the document that fills so many.
BLOCK, SEGMENT = 1024, 2048
#: Bits of the totals of the choice between predictions, and of the order-0 table.
CHOICE, ORDER0 = 12, 20
#: Slots of the id predictions of one block, by order.
SLOT_BITS1, SLOT_BITS2 = 9, 10
SLOTS1, SLOTS2 = 1 << SLOT_BITS1, 1 << SLOT_BITS2
#: Confidence of a prediction goes up to this; a weight moves by this power of two of what it was off.
SURE, SPEED = 15, 5

FULL, OPEN = np.int32(1 << CHOICE), np.int32((1 << CHOICE) - 32)
#: A weight moves towards the first of these after a miss and the second after a hit, so it stays between 1 and FULL - 64.
MISS, HIT = 1, (1 << CHOICE) - 64 + (1 << SPEED) - 1
#: What a slot changes by, by its confidence after a miss, then after a hit.
STEPS = np.array([-((c + 1) >> 1) for c in range(SURE + 1)] + [int(c < SURE) for c in range(SURE + 1)]).astype(np.uint32)
#: The coder's numbers are whole and below 2**50, so doubles hold them exactly, and their quotients are never rounded up to the next whole number.
TOP, LEAST, DIGIT = 2.0**48, 2.0**32, 2.0**16
TO_CHOICE, TO_ORDER0 = 2.0**-CHOICE, 2.0**-ORDER0


def order0_table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids that occur and their shares of 2**ORDER0, one at least."""
    kinds, counts = np.unique(ids, return_counts=True)
    spare = (1 << ORDER0) - len(kinds)
    share = 1 + (counts * (spare / max(1, counts.sum()))).astype(np.int64)
    share[int(counts.argmax())] += (1 << ORDER0) - share.sum()
    return kinds.astype(np.uint32), share.astype(np.uint32)


class Model:
    """Id predictions of order 1 and 2 for each lane, and the weights that mix them, by their confidence so far.

    A slot holds an id and, in its low byte, how sure the prediction is. The first row of each pair is order 1's.
    """

    def __init__(self, lanes: int) -> None:
        lane = np.arange(lanes, dtype=np.int64)
        self.base = np.stack([lane * SLOTS1, lanes * SLOTS1 + lane * SLOTS2])
        self.slots = np.zeros(lanes * (SLOTS1 + SLOTS2), np.uint32)
        levels = SURE + 1
        self.level = np.stack([lane, lanes + lane]) * levels
        self.weight = np.tile((((np.arange(levels) + 0.2) / (levels + 2)) * (1 << CHOICE)).astype(np.int32), 2 * lanes)
        self.last, self.before = np.zeros(lanes, np.uint32), np.zeros(lanes, np.uint32)
        self.hash = np.empty((2, lanes), np.uint32)

    def predict(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the first ``n`` lanes the ids of order 1 and 2, order 2's share of 2**CHOICE, and both orders' share; the rest is order 0's."""
        last, hashed = self.last[:n], self.hash[:, :n]
        np.right_shift(last * np.uint32(0x9E3779B1), np.uint32(32 - SLOT_BITS1), out=hashed[0])
        np.right_shift(last * np.uint32(0x85EBCA6B) + self.before[:n] * np.uint32(0xC2B2AE35), np.uint32(32 - SLOT_BITS2), out=hashed[1])
        self.at = self.base[:, :n] + hashed
        self.s = self.slots.take(self.at)
        self.c = self.s & np.uint32(0xFF)
        self.k = self.level[:, :n] + self.c
        self.w = self.weight.take(self.k)
        share2 = self.w[1]
        both = OPEN - share2
        both *= self.w[0]
        both >>= CHOICE
        both += share2
        both += 1
        return self.s >> np.uint32(8), share2, both

    def learn(self, n: int, x: np.ndarray, hits: np.ndarray) -> None:
        """Take in the ids that came; ``hits`` is which orders would have been right."""
        move = hits * np.int32(HIT - MISS)
        move -= self.w
        move += MISS
        move >>= SPEED
        # order 1 is asked only where order 2 fails
        move[0] *= ~hits[1]
        move += self.w
        self.weight[self.k] = move
        slots = self.s + STEPS.take(self.c + hits * np.uint32(SURE + 1))
        new = x << np.uint32(8)
        new += np.uint32(1)
        self.slots[self.at] = np.where((self.c < 2) > hits, new, slots)
        self.before[:n] = self.last[:n]
        self.last[:n] = x


def encode_blocks(blocks: list[np.ndarray], kinds: np.ndarray, shares: np.ndarray) -> list[bytes]:
    """The coded bytes of each block. Blocks must not grow in length from one to the next."""
    lanes = len(blocks)
    length = np.array(list(map(len, blocks)))
    steps = int(length[0])
    ids = np.zeros((steps, lanes), np.uint32)
    for i, b in enumerate(blocks):
        ids[: len(b), i] = b
    shortest = int(length[-1])
    widths0 = np.zeros(int(kinds[-1]) + 1)
    widths0[kinds] = shares
    starts0 = np.cumsum(widths0) - widths0
    model = Model(lanes)
    low, span = np.zeros(lanes), np.full(lanes, TOP)
    used = np.zeros(lanes, np.int64)
    # digits and the lanes they belong to as they come, and the places that a carry went to
    digits: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    carries: list[tuple[np.ndarray, np.ndarray]] = []

    def put(some: np.ndarray) -> None:
        now = low[some]
        digit = np.floor(now * (1 / LEAST))
        digits.append(digit.astype(np.int32))
        owners.append(some.astype(np.int32))
        used[some] += 1
        low[some] = (now - digit * LEAST) * DIGIT

    for t in range(steps):
        n = int(np.searchsorted(-length, -t, "left")) if t >= shortest else lanes
        x = ids[t, :n]
        guesses, share2, both = model.predict(n)
        hits = guesses == x
        hit1, hit2 = hits
        missed = ~(hit1 | hit2)
        start = np.where(hit2, 0, np.where(hit1, share2, both))
        end = np.where(hit2, share2, np.where(hit1, both, FULL))
        part = np.floor(span[:n] * TO_CHOICE)
        now = low[:n]
        now += part * start
        wide = part * (end - start)
        # a choice leaves 2**20 of a lane's span at least, so order 0 can follow before digits go out
        part = np.floor(wide * TO_ORDER0)
        part *= missed
        now += part * starts0.take(x)
        span[:n] = np.where(missed, part * widths0.take(x), wide)
        if len(over := np.flatnonzero(now >= TOP)):
            carries.append((over, used[over] - 1))
            low[over] -= TOP
        short = np.flatnonzero(span < LEAST)
        while len(short):
            put(short)
            wide = span[short] * DIGIT
            span[short] = wide
            short = short[wide < LEAST]
        model.learn(n, x, hits)
    for _ in range(3):
        put(np.arange(lanes))
    owner = np.concatenate(owners)
    flat = np.concatenate(digits)[np.argsort(owner.astype(np.uint16) if lanes <= 1 << 16 else owner, kind="stable")]
    ends = np.cumsum(used)
    for lane, at in carries:
        flat[ends[lane] - used[lane] + at] += 1
    while len(found := np.flatnonzero(flat > 0xFFFF)):
        flat[found] -= 1 << 16
        flat[found - 1] += 1
    raw = flat.astype(">u2").tobytes()
    return [raw[2 * a : 2 * b] for a, b in zip((ends - used).tolist(), ends.tolist(), strict=True)]


def decode_blocks(coded: list[bytes], length: list[int], kinds: np.ndarray, shares: np.ndarray) -> list[np.ndarray]:
    """The ids of each block; the inverse of ``encode_blocks``."""
    lanes = len(coded)
    sizes = np.array(length)
    steps = int(sizes[0])
    digits = np.frombuffer(b"".join([*coded, bytes(8)]), ">u2").astype(np.uint16)
    used = np.cumsum([0, *map(len, coded[:-1])]) // 2
    last = len(digits) - 1
    shortest = int(sizes[-1])
    widths0 = shares.astype(np.float64)
    starts0 = np.cumsum(widths0) - widths0
    symbol = np.repeat(np.arange(len(kinds), dtype=np.uint16 if len(kinds) <= 1 << 16 else np.int32), shares)
    model = Model(lanes)
    value = (digits[used] * DIGIT + digits[used + 1]) * DIGIT + digits[used + 2]
    used += 3
    span = np.full(lanes, TOP)
    ids = np.zeros((steps, lanes), np.uint32)

    for t in range(steps):
        n = int(np.searchsorted(-sizes, -t, "left")) if t >= shortest else lanes
        guesses, share2, both = model.predict(n)
        part = np.floor(span[:n] * TO_CHOICE)
        at = np.minimum((value[:n] / part).astype(np.int32), FULL - 1)
        first, second = at < share2, at < both
        start = np.where(first, 0, np.where(second, share2, both))
        end = np.where(first, share2, np.where(second, both, FULL))
        value[:n] -= part * start
        span[:n] = part * (end - start)
        x = np.where(first, guesses[1], guesses[0])
        missed = np.flatnonzero(~second)
        if len(missed):
            part, now = np.floor(span[missed] * TO_ORDER0), value[missed]
            k = symbol.take(np.minimum((now / part).astype(np.int64), (1 << ORDER0) - 1))
            x[missed] = kinds.take(k)
            value[missed] = now - part * starts0.take(k)
            span[missed] = part * widths0.take(k)
        short = np.flatnonzero(span < LEAST)
        while len(short):
            at = used[short]
            value[short] = value[short] * DIGIT + digits.take(np.minimum(at, last))
            used[short] = at + 1
            wide = span[short] * DIGIT
            span[short] = wide
            short = short[wide < LEAST]
        ids[t, :n] = x
        model.learn(n, x, np.stack([guesses[0] == x, first]))
    return [np.ascontiguousarray(ids[: sizes[i], i]) for i in range(lanes)]


def write_segment(ids: np.ndarray, index: np.ndarray) -> bytes:
    """``ids`` as one segment; ``index`` (row, has an id, doc_id, number of ids) has a row for each document in it."""
    kinds, shares = order0_table(ids)
    blocks = [ids[i : i + BLOCK] for i in range(0, len(ids), BLOCK)]
    coded = [c for at in range(0, len(blocks), SEGMENT) for c in encode_blocks(blocks[at : at + SEGMENT], kinds, shares)]
    table = zlib.compress(np.concatenate([np.diff(kinds, prepend=0), shares]).astype("<u4").tobytes())
    docs = zlib.compress(np.ascontiguousarray(np.diff(index, axis=0, prepend=0).T).astype("<i8").tobytes())
    out = [MAGIC, struct.pack("<IIIII", len(blocks), len(kinds), len(table), len(index), len(docs)), table, docs]
    for b, c in zip(blocks, coded, strict=True):
        out += [struct.pack("<III", len(b), len(c), zlib.crc32(b.astype("<u4").tobytes())), c]
    body = b"".join(out)
    return body + struct.pack("<I", zlib.crc32(body))


def read_segment(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``ids, index`` of a segment; raises if a checksum does not hold."""
    if data[: len(MAGIC)] != MAGIC or struct.unpack("<I", data[-4:])[0] != zlib.crc32(data[:-4]):
        raise ValueError("not a whole segment")
    at = len(MAGIC)
    n_blocks, n_kinds, n_table, n_docs, n_index = struct.unpack_from("<IIIII", data, at)
    at += 20
    table = np.frombuffer(zlib.decompress(data[at : at + n_table]), "<u4").reshape(2, n_kinds)
    kinds, shares = np.cumsum(table[0], dtype=np.uint32), table[1]
    at += n_table
    index = np.cumsum(np.frombuffer(zlib.decompress(data[at : at + n_index]), "<i8").reshape(-1, n_docs).T, axis=0)
    at += n_index
    coded, length, sums = [], [], []
    for _ in range(n_blocks):
        n, size, crc = struct.unpack_from("<III", data, at)
        at += 12
        coded.append(data[at : at + size])
        length.append(n)
        sums.append(crc)
        at += size
    blocks = [b for at in range(0, n_blocks, SEGMENT) for b in decode_blocks(coded[at : at + SEGMENT], length[at : at + SEGMENT], kinds, shares)]
    for b, crc in zip(blocks, sums, strict=True):
        if zlib.crc32(b.astype("<u4").tobytes()) != crc:
            raise ValueError("a block does not match its checksum")
    return np.concatenate(blocks), index


SEGMENTS = "part int, segment int, first long, n_tokens long, data binary"


def write_tokens(docs: DataFrame, path: str, tokenizer: str = WORD_BPE, end: int = END) -> None:
    """Write the ids of all documents, each with its end id, to ``path``: one file of segments per range of ids, in ascending order.

    The files are Parquet, so any store that Spark reaches takes them, with one segment in a row; a lost task is written again. A null text is empty; rows
    without an id come first; rows of one id are in the order of a hash of their text. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder = kept_by_worker(("words", tokenizer), lambda: WordEncoder(tokenizer))
        most = BLOCK * SEGMENT
        last = np.array([end], np.uint32)
        held: list[np.ndarray] = []
        index: list[tuple[int, int, int, int]] = []
        size, first, segment, row = 0, 0, 0, 0

        def close() -> pa.RecordBatch:
            nonlocal held, index, size, first, segment
            data = write_segment(np.concatenate(held), np.array(index, np.int64))
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([first], pa.int64()), pa.array([size], pa.int64()), pa.array([data], pa.binary())],
                ["part", "segment", "first", "n_tokens", "data"],
            )
            held, index, first, segment, size = [], [], first + size, segment + 1, 0
            return out

        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for lo in range(0, len(texts), 1024):
                some = [t or b"" for t in texts[lo : lo + 1024].to_pylist()]
                for doc_id, ids in zip(batch.column(0)[lo : lo + 1024].to_pylist(), encoder.encode_all(some), strict=True):
                    held += [ids, last]
                    index.append((row, doc_id is not None, doc_id or 0, len(ids) + 1))
                    size += len(ids) + 1
                    if size >= most:
                        yield close()
                    row += 1
        if size:
            yield close()
        pa.default_memory_pool().release_unused()

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = source.repartitionByRange(F.col("doc_id")).sortWithinPartitions(F.col("doc_id"), F.xxhash64("text"))
    ordered.mapInArrow(run, SEGMENTS).write.mode("error").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, ids_bytes`` of the documents in the files at ``path``, decoded and verified.

    ``ids_bytes`` are the ids as little-endian unsigned 32-bit integers. ``start`` counts the ids of all documents before.
    """
    segments = spark.read.schema(SEGMENTS).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, data in zip(batch.column("part").to_pylist(), batch.column("first").to_pylist(), batch.column("data"), strict=True):
                ids, index = read_segment(data.as_py())
                raw = ids.astype("<u4").tobytes()
                ends = np.cumsum(index[:, 3])
                starts = ends - index[:, 3]
                pieces = [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(index), part, np.int32)), pa.array(index[:, 2], mask=index[:, 1] == 0), pa.array(first + starts),
                        pa.array(index[:, 3]), pa.array(list(map(zlib.crc32, pieces)), pa.int64()), pa.array(pieces, pa.binary()),
                    ],
                    ["part", "doc_id", "at", "n_tokens", "crc", "piece"],
                )

    pieces = segments.mapInArrow(run, "part int, doc_id long, at long, n_tokens long, crc long, piece binary")
    sums = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select(F.col("part").alias("_part"), before.alias("_before"))
    met = pieces.join(offsets, F.col("part") == F.col("_part"))
    return met.select("doc_id", (F.col("at") + F.col("_before")).alias("start"), "n_tokens", F.col("crc").alias("ids_crc32"), F.col("piece").alias("ids_bytes"))


def round_trip(docs: DataFrame, tokenizer: str = WORD_BPE, end: int = END) -> DataFrame:
    """``docs`` written to a folder of the run in the shared folder, and read back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    write_tokens(docs, path, tokenizer, end)
    return read_tokens(spark, path)
