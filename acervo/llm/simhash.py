"""SimHash near-duplicates: fingerprints, a binary trie self-join under a Hamming budget, and connected components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from acervo.llm.arrow import slices
from acervo.session import materialise

#: Differing bits up to which two fingerprints link.
BUDGET = 4
SEED = 42
#: The fingerprint is cut into blocks; pairs within the budget agree in all but ``budget`` of them.
BLOCKS_OVER_BUDGET = 2
#: A pair of trie nodes with so few pairs of fingerprints is compared directly.
LEAF_PAIRS = 64
#: Node pairs of one step of the traversal.
FRONTIER = 1 << 13
#: Fingerprints that a task holds before it walks their tries.
BATCH = 200_000


def fingerprint(text: bytes, size: int, distinct: bool = False) -> int:
    """64-bit SimHash of the word shingles of ``text`` with A-Z lower-cased; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-1]])[: len(words) - size + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)]
    if distinct:
        hashes = set(hashes)
    h = np.fromiter(hashes, np.uint64, len(hashes))
    bits = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = 4, distinct: bool = False) -> DataFrame:
    """``doc_id, fp`` for every row; the fingerprint as a signed long. A null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(1).cast(pa.binary())
            fps = [fingerprint(t.as_py() or b"", size, distinct) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def block_masks(budget: int) -> list[int]:
    """For every choice of blocks that two fingerprints within the budget may agree in, the mask of their bits."""
    n = budget + BLOCKS_OVER_BUDGET
    edges = [round(64 * i / n) for i in range(n + 1)]
    blocks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:], strict=False)]
    return [reduce(int.__or__, chosen) for chosen in combinations(blocks, BLOCKS_OVER_BUDGET)]


class Forest:
    """Disjoint sets over positions; every joining link is kept, so that the links form a forest."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)
        self.up = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Link positions pairwise: numpy drops what is linked already, so only joins reach the loop."""
        while len(a):
            ra, rb = self.root[a], self.root[b]
            open_ = ra != rb
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            if not len(a):
                return
            # one link for each larger root per round: hooks larger roots under smaller ones
            high, low = np.maximum(ra, rb), np.minimum(ra, rb)
            _, first = np.unique(high, return_index=True)
            self.links += zip(a[first].tolist(), b[first].tolist(), strict=True)
            # roots hang on smaller ones, so following them ends
            self.up[high[first]] = low[first]
            roots = high[first]
            while not np.array_equal(up := self.up[self.up[roots]], self.up[roots]):
                self.up[roots] = up
            self.root = self.up[self.root]


def trie_links(groups: np.ndarray, fps: np.ndarray, budget: int) -> list[tuple[int, int]]:
    """Links that connect, within each group, all fingerprints within ``budget`` bits of each other.

    ``fps`` (unsigned, sorted within the sorted ``groups``) are the leaves of one binary trie per group, whose nodes are
    ranges of positions. The walk takes pairs of nodes of one depth down together: a pair of children that differ in
    the bit of that depth costs one of the budget, and a pair over budget is dropped with all below. Pairs
    of nodes that lie in one connected set already are dropped too; they could add no link.
    """
    n = len(fps)
    starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]])) if n else np.zeros(0, int)
    ends = np.append(starts[1:], n)
    big = ends - starts > 1
    forest = Forest(n)
    zeros: dict[int, np.ndarray] = {}

    def split(depth: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if depth not in zeros:
            bit = (fps >> np.uint64(63 - depth)) & np.uint64(1)
            zeros[depth] = np.concatenate([[0], np.cumsum(bit == 0)])
        return lo + zeros[depth][hi] - zeros[depth][lo]

    counted, changes = 0, np.zeros(max(n, 1), int)
    stack = [(0, starts[big], ends[big], starts[big], ends[big], np.zeros(big.sum(), np.int64))]
    while stack:
        depth, alo, ahi, blo, bhi, used = stack.pop()
        if len(alo) > FRONTIER:
            half = len(alo) // 2
            stack += [(depth, *(x[half:] for x in (alo, ahi, blo, bhi, used))), (depth, *(x[:half] for x in (alo, ahi, blo, bhi, used)))]
            continue
        live = (ahi > alo) & (bhi > blo) & (used <= budget)
        alo, ahi, blo, bhi, used = (x[live] for x in (alo, ahi, blo, bhi, used))
        if len(forest.links) != counted:
            counted, changes = len(forest.links), np.concatenate([[0], np.cumsum(forest.root[1:] != forest.root[:-1])])
        if counted and len(alo):
            joined = (changes[ahi - 1] == changes[alo]) & (changes[bhi - 1] == changes[blo]) & (forest.root[alo] == forest.root[blo])
            alo, ahi, blo, bhi, used = (x[~joined] for x in (alo, ahi, blo, bhi, used))
        if not len(alo):
            continue
        pairs = (ahi - alo) * (bhi - blo)
        small = (pairs <= LEAF_PAIRS) | (depth == 64)
        if small.any():
            # at depth 64 a node is one fingerprint, as each occurs once in a group
            width = (bhi - blo)[small]
            count = pairs[small]
            which = np.repeat(np.arange(len(count)), count)
            nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            a = alo[small][which] + nth // width[which]
            b = blo[small][which] + nth % width[which]
            near = (a != b) & (np.bitwise_count(fps[a] ^ fps[b]) <= budget)
            a, b = a[near], b[near]
            nearest = np.argsort(np.bitwise_count(fps[a] ^ fps[b]), kind="stable")
            forest.add(a[nearest], b[nearest])
        alo, ahi, blo, bhi, used = (x[~small] for x in (alo, ahi, blo, bhi, used))
        if not len(alo):
            continue
        am, bm = split(depth, alo, ahi), split(depth, blo, bhi)
        same = alo == blo
        other = ~same
        # equal bits are walked before differing ones: the stack pops the last first
        down = [
            (np.concatenate([alo, alo[other]]), np.concatenate([am, am[other]]), np.concatenate([bm, bm[other]]), np.concatenate([bhi, bhi[other]]), np.concatenate([used, used[other]]) + 1),
            (np.concatenate([alo, am]), np.concatenate([am, ahi]), np.concatenate([blo, bm]), np.concatenate([bm, bhi]), np.concatenate([used, used])),
        ]
        crossed = down[0]
        # the second half of the differing pairs is (one-child, zero-child), which a self-pair has not
        m = len(alo)
        crossed[0][m:], crossed[1][m:], crossed[2][m:], crossed[3][m:] = am[other], ahi[other], blo[other], bm[other]
        stack += [(depth + 1, *x) for x in down]
    return forest.links


def linked_fingerprints(fps: DataFrame, budget: int = BUDGET) -> DataFrame:
    """``a, b``: links between the distinct fingerprints of ``fps`` that connect all pairs within the budget.

    Two fingerprints within the budget agree in at least two of ``budget + 2`` blocks. For each pair of blocks, those that
    agree in them form a group, the part of a trie that starts with these bits where the walk has spent nothing yet.
    Groups lie whole in a partition, sorted, so a task walks the tries of many small groups at once.
    Fingerprints are distinct here: copies of a text add nothing to a group.
    """
    masks = [m - (1 << 64) if m >> 63 else m for m in block_masks(budget)]
    keyed = fps.select(
        "fp", F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks)])).alias("k")
    ).select(F.col("k.choice").alias("choice"), F.col("k.bits").alias("bits"), "fp")
    dealt = keyed.repartition(F.col("choice"), F.col("bits")).sortWithinPartitions("choice", "bits")

    def links(choice: np.ndarray, bits: np.ndarray, fp: np.ndarray) -> pa.RecordBatch | None:
        order = np.lexsort((fp.view(np.uint64), bits, choice))
        choice, bits, fp = choice[order], bits[order], fp[order]
        new = np.concatenate([[True], (choice[1:] != choice[:-1]) | (bits[1:] != bits[:-1])])
        found = trie_links(np.cumsum(new), fp.view(np.uint64), budget)
        if not found:
            return None
        at = np.array(found)
        return pa.RecordBatch.from_arrays([pa.array(fp[at[:, 0]]), pa.array(fp[at[:, 1]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n = 0
        for batch in batches:
            held.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            n += batch.num_rows
            if n < BATCH:
                continue
            choice, bits, fp = (np.concatenate(c) for c in zip(*held, strict=True))
            # the last group may go on in the next batch
            cut = np.flatnonzero((choice != choice[-1]) | (bits != bits[-1]))
            cut = cut[-1] + 1 if len(cut) else 0
            if cut and (out := links(choice[:cut], bits[:cut], fp[:cut])):
                yield out
            held, n = [(choice[cut:], bits[cut:], fp[cut:])], len(fp) - cut
        if n:
            choice, bits, fp = (np.concatenate(c) for c in zip(*held, strict=True))
            if out := links(choice, bits, fp):
                yield out

    return dealt.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable, for every node of ``edges`` (a, b long).

    Rounds of two steps: every node hangs its larger neighbours on the smallest node it sees, then its smaller ones. What
    is left when nothing changes are stars. Each round is written to the shared folder; the smallest neighbour
    is an aggregate, so a node with many links is never gathered.
    """

    def hang(pairs: DataFrame, label: str) -> DataFrame:
        return materialise(pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)

    def digest(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    current = hang(edges, "simhash-links")
    before = digest(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = hang(both.join(least, "a").where("b > a").select("b", F.col("m")).toDF("a", "b"), "simhash-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select("b", "m").toDF("a", "b").unionByName(least.toDF("a", "b"))
        current = hang(small, "simhash-small")
        if (now := digest(current)) == before:
            break
        before = now
    return current.toDF("node", "root").unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(docs: DataFrame, size: int = 4, budget: int = BUDGET) -> DataFrame:
    """``doc_id, fp, component_id`` for every row: the smallest id reachable over fingerprints within ``budget`` bits.

    Equal fingerprints, such as those of copies, are one node; only the distinct ones are joined. Rows without words have fingerprint zero
    and link like any other. A null id takes part but never names a component, unless no id is there.
    Columns besides doc_id and text are ignored.
    """
    fps = materialise(fingerprints(docs, size), "simhash-fps")
    nodes = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    roots = components(linked_fingerprints(nodes, budget))
    joined = nodes.join(roots, F.col("fp") == F.col("node"))
    names = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    named = joined.join(names, "root").select(F.col("fp").alias("_fp"), "component_id")
    whole = nodes.join(named, F.col("fp") == F.col("_fp"), "left").select(
        F.col("fp").alias("_fp"), F.coalesce("component_id", "first").alias("component_id")
    )
    return fps.join(whole, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id")


#: Stage on whole documents: minima of hashed five-word shingles find candidates, the sets themselves decide.
SHINGLE, SIMILARITY = 5, 0.8
#: Candidates agree in all minima of a band. Of pairs at a similarity s, (1 - s ** BAND_ROWS) ** BANDS are not found: 1.5e-5 at 0.8.
BANDS, BAND_ROWS = 28, 5
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 32, (BANDS * BAND_ROWS, 1), dtype=np.uint32) | np.uint32(1)
#: Shingles hashed at once.
HASHED = 1 << 10
#: Parities of parts of a set's shingles, 64 in a column.
PARITIES = ["odd0", "odd1", "odd2", "odd3"]
#: A key's texts are compared with so many times more centres in each round.
SPREAD = 4


def shingle_set(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles of ``size`` words (all words, if fewer; none without words)."""
    words = text.lower().split()
    parts = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(p, SEED) for p in parts), np.uint64, len(parts))).view(np.int64)


def set_id(shingles: np.ndarray) -> int:
    """A hash of a whole set: texts with equal shingles are one node."""
    return int(np.int64(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), SEED)).view(np.int64)))


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """A key for each band of minima of the set under independent hashes; none for an empty set."""
    if not len(shingles):
        return np.zeros(0, np.int64)
    x = (shingles.view(np.uint64) >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(FACTORS), np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(x), HASHED):
        np.minimum(least, (FACTORS * x[at : at + HASHED]).min(axis=1), out=least)
    return np.array([xxhash.xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(least.reshape(BANDS, BAND_ROWS))], np.uint64).view(np.int64)


def alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: those of ``pairs`` (x, y) whose sets (node, shingles) have at least that Jaccard similarity."""
    left, right = (sets.select(F.col("node").alias(n), F.col("shingles").alias(s)) for n, s in (("x", "p"), ("y", "q")))
    shared = F.size(F.array_intersect("p", "q"))
    both = pairs.join(left, "x").join(right, "y")
    return both.where(shared >= similarity * (F.size("p") + F.size("q") - shared)).select(F.col("x").alias("a"), F.col("y").alias("b"))


def sketches(sets: DataFrame) -> DataFrame:
    """``node, alone`` and ``PARITIES``: how many shingles of a set no other one of ``sets`` has, and a parity of each of 256 parts of all others.

    Two parities differ only where the sets do: they have at least as many shingles apart as bits differ, beside their lone ones.
    """
    tokens = sets.select("node", F.explode("shingles").alias("shingle"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("shingle").bitwiseAND(F.lit(63)).cast("int"))
    part = F.call_function("shiftright", "shingle", F.lit(6)).bitwiseAND(F.lit(len(PARITIES) - 1))
    odd = [F.bit_xor(F.when(part == i, bit).otherwise(F.lit(0).cast("long"))).alias(name) for i, name in enumerate(PARITIES)]
    lone = tokens.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).where("n = 1")
    lone = lone.groupBy("node").agg(F.count(F.lit(1)).alias("alone"), *odd)
    lone = lone.select(F.col("node").alias("_node"), "alone", *[F.col(p).alias(f"_{p}") for p in PARITIES])
    both = tokens.groupBy("node").agg(*odd).join(lone, F.col("node") == F.col("_node"), "left")
    rest = [F.col(p).bitwiseXOR(F.coalesce(f"_{p}", F.lit(0).cast("long"))).alias(p) for p in PARITIES]
    return both.select("node", F.coalesce("alone", F.lit(0).cast("long")).alias("alone"), *rest)


def verified(members: DataFrame, sets: DataFrame, similarity: float, known: DataFrame | None = None) -> DataFrame | None:
    """``node, root`` of the nodes that link, or None: ``members`` (key, node, size, degree) of one key are candidates, ``sets`` decide.

    In each round the members of a key are compared with its centres, and those are then done. A centre is the member with most
    candidates over all keys: the text that a family of copies comes from shares keys with more of them than any copy does, so most keys
    are done in one round. Only what is not connected by
    verified links yet is compared; a pair that fails connects nothing, so its members stay to be compared with later centres. A key is done when
    all that is left of it is connected. The number of centres grows from round to round, from one: copies of a text
    need as many comparisons as there are copies, and keys of unlike texts as many rounds as the logarithm of their size.

    Two sets share at most what either has beside its lone shingles, and are apart in these and in every parity that differs; where that cannot
    reach the similarity, the pair is settled without the sets. ``known`` (a, b) are links that are verified already.
    """
    tested = None
    roots = None if known is None or known.isEmpty() else materialise(components(known), "near-roots")
    members = members.join(materialise(sketches(sets), "near-sketches"), "node").withColumn("common", F.col("size") - F.col("alone"))
    members = members.where(F.col("common") >= similarity * F.col("size")).drop("alone")
    if roots is not None:
        members = members.join(roots, "node", "left")
    members = members.withColumn("root", F.col("node") if roots is None else F.coalesce("root", "node"))
    columns = ["key", "node", "size", "degree", "common", *PARITIES, "root"]
    members, spread = materialise(members.select(columns), "near-members"), 1
    while not members.isEmpty():
        first = F.max(F.struct("degree", (-F.col("node")).alias("order"), "node", "size", "common", *PARITIES, "root")).alias("c")
        centres = members.groupBy("key", F.pmod(F.xxhash64("node"), F.lit(spread)).alias("part")).agg(first)
        centres = centres.select("key", F.col("c.node").alias("centre"), *[F.col(f"c.{f}").alias(f"centre_{f}") for f in ("size", "common", *PARITIES, "root")])
        centres = materialise(centres, "near-centres")
        both = F.col("size") + F.col("centre_size")
        differ = reduce(Column.__add__, [F.bit_count(F.col(p).bitwiseXOR(F.col(f"centre_{p}"))) for p in PARITIES])
        apart = both - F.col("common") - F.col("centre_common") + differ
        most = F.least(F.col("common").cast("double"), F.col("centre_common").cast("double"), (both - apart) / 2)
        fits = (F.col("root") != F.col("centre_root")) & (most >= similarity * (both - most))
        pairs = members.join(centres, "key").where(fits).select(F.least("node", "centre").alias("x"), F.greatest("node", "centre").alias("y")).distinct()
        pairs = materialise(pairs if tested is None else pairs.join(tested, ["x", "y"], "left_anti"), "near-pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = materialise(alike(pairs, sets, similarity), "near-links")
        if not links.isEmpty():
            known = links if roots is None else links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
            roots = materialise(components(known), "near-roots")
        done = centres.select("key", F.col("centre").alias("node"))
        rest = members.join(done, ["key", "node"], "left_anti")
        if roots is not None:
            rest = rest.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        rest = materialise(rest.select(columns), "near-rest")
        apart = rest.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
        members, spread = materialise(rest.join(apart, "key"), "near-members"), spread * SPREAD
    return roots


def fingerprint_pairs(nodes: DataFrame, budget: int = BUDGET) -> DataFrame:
    """``x, y``: nodes (node, fp) whose fingerprints the trie join links, and nodes of one fingerprint with the first of it."""
    heads = materialise(nodes.groupBy("fp").agg(F.min("node").alias("head")), "near-heads")
    left, right = (heads.select(F.col("fp").alias(f), F.col("head").alias(n)) for f, n in (("a", "x"), ("b", "y")))
    across = linked_fingerprints(heads, budget).join(left, "a").join(right, "b").select("x", "y")
    return across.unionByName(nodes.join(heads, "fp").where("node <> head").select(F.col("node").alias("x"), F.col("head").alias("y")))


def near_groups(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, node, keeper`` per row: the smallest id of the document's group of near-duplicates.

    Documents link if the Jaccard similarity of their five-word shingles is at least ``similarity``. The links of the SimHash fingerprints, found by the
    trie join of ``near_duplicates``, come first, and the sets decide. What differs in more bits at that similarity is completed: further candidates
    agree in a band of minima of their hashed shingles; each is compared exactly, unless verified links connect it already.
    Copies with equal shingles are one node.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            nodes, sizes, keys, fps = [], [], [], []
            for text in batch.column(1).cast(pa.binary()):
                shingles = shingle_set(text.as_py() or b"")
                fps.append(fingerprint(text.as_py() or b"", 4))
                nodes.append(set_id(shingles))
                sizes.append(len(shingles))
                keys.append(band_keys(shingles))
            columns = [batch.column(0), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(keys, pa.list_(pa.int64())), pa.array(np.array(fps, np.uint64).view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "size", "keys", "fp"])

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    marked = materialise(source.mapInArrow(run, "doc_id long, node long, size int, keys array<long>, fp long"), "near-marked")
    nodes = materialise(marked.groupBy("node").agg(F.min("doc_id").alias("first"), F.min("fp").alias("fp")), "near-nodes")
    links = materialise(fingerprint_pairs(nodes), "near-simhash")
    keyed = materialise(marked.select(F.explode("keys").alias("key"), "node", "size").distinct(), "near-keys")
    several = keyed.groupBy("key").agg((F.count(F.lit(1)) - 1).alias("others")).where("others > 0")
    met = materialise(keyed.join(several, "key").select("key", "node", "size", "others"), "near-met")
    degrees = met.groupBy("node").agg(F.sum("others").alias("degree"))
    members = materialise(met.drop("others").join(degrees, "node").select("key", "node", "size", "degree"), "near-candidates")
    ends = members.select("node").unionByName(links.select(F.explode(F.array("x", "y")).alias("node")))
    wanted = ends.distinct().join(nodes, "node").select("first")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shingle_set(t.as_py() or b"") for t in batch.column(0).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(list(map(set_id, found)), pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["node", "shingles"])

    texts = source.join(wanted.distinct(), source["doc_id"].eqNullSafe(F.col("first")), "left_semi").select("text")
    shingles = materialise(texts.mapInArrow(sets, "node long, shingles array<long>").dropDuplicates(["node"]), "near-sets")
    known = materialise(alike(links, shingles, similarity), "near-simhash-links")
    roots = verified(members, shingles, similarity, known)
    if roots is None:
        joined = nodes.select("node", "first", F.col("node").alias("root"))
    else:
        joined = nodes.drop("fp").join(roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").withColumn("root", F.coalesce("root", "node"))
    keepers = joined.groupBy("root").agg(F.min("first").alias("keeper"))
    whole = joined.select("node", "root").join(keepers, "root").select(F.col("node").alias("_node"), "keeper")
    return marked.join(whole, F.col("node") == F.col("_node")).select("doc_id", "node", "keeper")


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each group of near-duplicates of ``docs``: that of the smallest id.

    Texts without words are alike; so are a null and an empty text. A group without ids keeps one row. Rows that share an
    id stay or go by their own text, and of rows equal in id and text one stays. All columns are carried through.
    """
    groups = materialise(near_groups(docs, similarity), "near-groups")
    gone = groups.where(~F.col("doc_id").eqNullSafe(F.col("keeper"))).select(F.col("doc_id").alias("gone"), F.col("node").alias("gone_node"))
    repeated = materialise(groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").select(F.col("doc_id").alias("twice")), "near-repeated")
    # a row is one value beside the names used here
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("words"))
    if repeated.isEmpty():
        return rows.join(gone.select("gone").distinct(), F.col("id") == F.col("gone"), "left_anti").select("row.*")
    # ids that several rows share: their rows are compared by text
    single = rows.join(repeated, rows["id"].eqNullSafe(F.col("twice")), "left_anti")
    single = single.join(gone.select("gone").distinct(), single["id"] == F.col("gone"), "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            nodes = [set_id(shingle_set(t.as_py() or b"")) for t in batch.column("words").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.int64())], [*batch.schema.names, "of"])

    shared = rows.join(repeated, rows["id"].eqNullSafe(F.col("twice")), "left_semi")
    marked = shared.mapInArrow(run, StructType([*shared.schema.fields, StructField("of", LongType())]))
    kept = marked.join(gone.distinct(), marked["id"].eqNullSafe(F.col("gone")) & (F.col("of") == F.col("gone_node")), "left_anti")
    # a group keeps its smallest id, so what is left of an id and a node is one text many times
    first = kept.withColumn("nth", F.row_number().over(W.partitionBy("id", "of").orderBy(F.xxhash64("words")))).where("nth = 1")
    return single.select("row.*").unionByName(first.select("row.*"))
