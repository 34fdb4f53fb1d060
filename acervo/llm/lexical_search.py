"""Ranked lexical search: documents cut down to the items' vocabulary, equal bags scored once, their members expanded at the end."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.llm.arrow import slices
from acervo.operators.dedup import top_per_key
from acervo.operators.joins import spread_join
from acervo.session import materialise

#: Documents returned per item.
TOP = 20
#: Items, and distinct terms, of a block at most (one item always fits): the bound of what a task is sent.
BLOCK_ITEMS, BLOCK_TERMS = 4096, 200_000
#: Items scored at once, and cells of the term-by-item table of one such tile.
TILE_ITEMS, TILE_CELLS = 256, 1 << 22
#: Sums of whole numbers below this are exact in doubles.
EXACT = 1 << 53
#: ASCII bytes that are no letter or digit end a term; A-Z are lower-cased; bytes of other characters stay.
LETTERS = bytes(ord(chr(b).lower()) if b >= 128 or chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))

BAG = np.dtype([("term", "<i4"), ("tf", "<i4")])


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(LETTERS).split()


class Block:
    """Items with their terms; terms are numbered in the order of their bytes."""

    def __init__(self, items: list[tuple[int | None, Counter]]) -> None:
        self.ids = [i for i, _ in items]
        words = sorted(set().union(*(bag.keys() for _, bag in items)))
        self.number = {w: n for n, w in enumerate(words)}
        self.items = [
            (np.fromiter((self.number[w] for w in bag), np.int64, len(bag)), np.fromiter(bag.values(), np.int64, len(bag))) for _, bag in items
        ]

    def tiles(self, weights: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """``(first item, row of each term or -1, weight table)``: the items in tiles, each with the terms it has."""
        found, at = [], 0
        while at < len(self.items):
            until, used = at, set()
            while until < len(self.items) and until - at < TILE_ITEMS:
                more = used.union(self.items[until][0].tolist())
                if until > at and len(more) * (until + 1 - at) > TILE_CELLS:
                    break
                used, until = more, until + 1
            terms = np.array(sorted(used), np.int64)
            row = np.full(len(self.number) + 1, -1, np.int32)
            row[terms] = np.arange(len(terms))
            table = np.zeros((len(terms), until - at), np.int64)
            for column, (which, times) in enumerate(self.items[at:until]):
                table[row[which], column] = weights[which] * times
            # a document adds less than a million times the weight
            if len(terms) and int(table.sum(axis=0).max()) * 1_000_000 < EXACT:
                table = table.astype(np.float64)
            found.append((at, row, table))
            at = until
        return found


def blocks_of(items: DataFrame) -> Iterator[Block]:
    """The distinct rows of ``items`` in blocks of bounded size; items without terms match nothing and are left out."""
    held, words = [], set()
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null").distinct().orderBy("item_id", "text")
    for item_id, text in rows.toLocalIterator():
        bag = Counter(terms_of(text.encode()))
        if not bag:
            continue
        more = words | bag.keys()
        if held and (len(held) == BLOCK_ITEMS or len(more) > BLOCK_TERMS):
            yield Block(held)
            held, more = [], set(bag)
        held.append((item_id, bag))
        words = more
    if held:
        yield Block(held)


def restricted(docs: DataFrame, block: Block) -> DataFrame:
    """``doc_id, n, bag``: the number of terms of every document, and (term, occurrences) for the terms of the block, null if it has none."""
    number = block.number

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, bags = [], []
            for text in batch.column(1).cast(pa.binary()):
                words = terms_of(text.as_py() or b"")
                sizes.append(len(words))
                met = np.fromiter((i for i in map(number.get, words) if i is not None), np.int32)
                which, times = np.unique(met, return_counts=True)
                bag = np.empty(len(which), BAG)
                bag["term"], bag["tf"] = which, times
                bags.append(bag.tobytes() if len(bag) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())], ["doc_id", "n", "bag"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n long, bag binary")


def document_counts(bags: DataFrame, terms: int) -> np.ndarray:
    """The number of documents that hold each term of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            met = np.frombuffer(b"".join(batch.column(0).to_pylist()), BAG)
            total += np.bincount(met["term"], minlength=terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["term", "df"])

    counted = bags.where("bag is not null").select("bag").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(terms, np.int64)
    for row in counted.toLocalIterator():
        df[row["term"]] = row["df"]
    return df


def classes_of(bags: DataFrame, documents: int, length: int) -> DataFrame:
    """``hash, bag, m, first``: documents of the same bag and m are one class, named by its smallest id.

    The hash deals the classes out; the grouping compares bag and m in full, so classes of one hash stay apart.
    """
    return with_m(bags, documents, length).groupBy("hash", "bag", "m").agg(F.min("doc_id").alias("first"))


def with_m(bags: DataFrame, documents: int, length: int) -> DataFrame:
    m = F.expr(f"75 + ((25 * n * {documents}L) div {max(length, 1)}L)")
    return bags.where("bag is not null").select("doc_id", "bag", m.alias("m")).withColumn("hash", F.xxhash64("bag", "m"))


def best_classes(classes: DataFrame, block: Block, weights: np.ndarray, k: int) -> DataFrame:
    """``item, score, hash, bag, m, first``: of the classes that a task sees, the k best of every item (place in the block).

    Order: score, smallest id (null last), then bag and m by a hash of their own. A class holds its own first document, so
    the k best classes hold the k best documents.
    """
    tiles = block.tiles(weights)
    last = np.iinfo(np.int64).max

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros(0, [("item", "i8"), ("score", "i8"), ("null", "?"), ("first", "i8"), ("tie", "u8"), ("at", "i8")])
        floor = np.ones(len(block.items), np.int64)
        rows: dict[int, tuple] = {}
        seen = 0
        for batch in slices(batches):
            hashes, bags, ms, firsts = (batch.column(c).to_pylist() for c in ("hash", "bag", "m", "first"))
            ids = [np.frombuffer(b, BAG) for b in bags]
            met = []
            for first_item, row, table in tiles:
                scores = np.zeros((len(ids), table.shape[1]), np.int64)
                for n, bag in enumerate(ids):
                    where = row[bag["term"]]
                    has = where >= 0
                    tf = bag["tf"][has].astype(np.int64)
                    if len(tf):
                        worth = (1_000_000_000 * tf) // (1000 * tf + 12 * ms[n])
                        scores[n] = worth.astype(table.dtype) @ table[where[has]]
                n, item = np.nonzero(scores >= floor[None, first_item : first_item + table.shape[1]])
                new = np.zeros(len(n), kept.dtype)
                new["item"], new["score"], new["at"] = item + first_item, scores[n, item], n + seen
                new["null"] = np.array([f is None for f in firsts], bool)[n]
                new["first"] = np.array([last if f is None else f for f in firsts], np.int64)[n]
                ties = np.array([xxhash.xxh64_intdigest(b, m & 0xFFFF_FFFF) for b, m in zip(bags, ms, strict=True)], np.uint64)
                new["tie"] = ties[n]
                met.append(new)
            for n in {int(i) - seen for new in met for i in np.unique(new["at"])}:
                rows[n + seen] = hashes[n], bags[n], ms[n], firsts[n]
            seen += len(ids)
            every = np.concatenate([kept, *met])
            every = every[np.lexsort((every["tie"], every["first"], every["null"], -every["score"], every["item"]))]
            begins = np.flatnonzero(np.r_[True, every["item"][1:] != every["item"][:-1]]) if len(every) else np.zeros(0, np.int64)
            place = np.arange(len(every)) - np.repeat(begins, np.diff(np.r_[begins, len(every)]))
            kept = every[place < k]
            full = every[place == k - 1]
            floor[full["item"]] = full["score"]
            rows = {at: rows[at] for at in np.unique(kept["at"]).tolist()}
        columns = list(zip(*(rows[at] for at in kept["at"].tolist()), strict=True)) or [(), (), (), ()]
        arrays = [pa.array(kept["item"]), pa.array(kept["score"])]
        arrays += [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.int64(), pa.int64()), strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["item", "score", "hash", "bag", "m", "first"])

    return classes.select("hash", "bag", "m", "first").mapInArrow(run, "item long, score long, hash long, bag binary, m long, first long")


def search_block(docs: DataFrame, block: Block, k: int) -> DataFrame:
    bags = materialise(restricted(docs, block), "lexical-bags")
    documents, length = bags.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = document_counts(bags, len(block.number))
    weights = np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)
    found = best_classes(classes_of(bags, documents, length), block, weights, k)
    best = materialise(top_per_key(found, ["item"], [F.desc("score"), F.asc_nulls_last("first"), F.asc("hash"), F.asc("bag"), F.asc("m")], k), "lexical-classes")
    wanted = best.select("hash", F.col("bag").alias("its_bag"), F.col("m").alias("its_m")).distinct()
    same = (F.col("bag") == F.col("its_bag")) & (F.col("m") == F.col("its_m"))
    # of a class no more than k members can rank; spread, so that every task cuts its part of a large class down first
    found = spread_join(with_m(bags, documents, length), wanted, "hash").where(same)
    members = top_per_key(found, ["hash", "bag", "m"], [F.asc_nulls_last("doc_id")], k)
    ranked = top_per_key(
        best.select("item", "score", "hash", "bag", "m").join(members.select("hash", "bag", "m", "doc_id"), ["hash", "bag", "m"]),
        ["item"], [F.desc("score"), F.asc_nulls_last("doc_id")], k, "rank",
    )
    names = docs.sparkSession.createDataFrame(list(enumerate(block.ids)), "item long, item_id long")
    return ranked.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of every item with a score above 0, equal scores by id.

    Documents are restricted to the items' terms in one pass; those with the same occurrences and the same m score alike, so each class of
    them is scored once, and its members are expanded by ascending id. A term that an item repeats counts
    as often. Every row of ``docs`` is a document, rows of one id or equal rows too; a null id ranks last. Null and empty texts have no
    terms: such documents never match and do not count in N, such items return nothing. Rows of ``items`` equal
    in id and text are one item; several texts of one id are several items. Other columns are ignored.
    Items are taken in blocks of at most ``BLOCK_ITEMS`` and ``BLOCK_TERMS`` terms, with one pass over the documents for each.
    """
    result = None
    for block in blocks_of(items):
        found = search_block(docs, block, k)
        result = found if result is None else result.unionByName(found)
    if result is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return result
