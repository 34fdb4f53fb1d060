"""Periodic runs of words: a run-length grammar by recompression, and exact extensions of harmonic-grid candidates through it."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.llm.arrow import slices

#: Repetitions that make a run, and its words at least.
EXPONENT, SHORTEST = 4, 6
#: Grid points looked at together.
PIECE = 1 << 20
#: Words of two copies that must agree next to a grid point, on one side: an extension of half of (EXPONENT - 1) periods, or of
#: SHORTEST - 1 words, is longer on one of them.
SIDE = 3
#: Multiplier that deals symbols to the left or the right side of pairs, anew at every level.
MIX = np.uint64(0x9E3779B97F4A7C15)


class Grammar:
    """A run-length grammar of a sequence by recompression.

    Levels alternate: block compression gives every maximal repetition of one symbol a symbol, pair compression splits the
    alphabet in two and gives every pair (left, right) one. Equal stretches are parsed alike but for their margins, so
    a longest common extension is read off a few symbols of each level.
    """

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        level = words.astype(np.int64)
        starts = np.arange(n + 1)
        self.levels: list[tuple[list, list, list, np.ndarray]] = []
        self.keep(level, starts)
        fresh = int(level.max(initial=0)) + 1
        step = 0
        while len(level) > 1:
            if step % 2 == 0:
                first = np.r_[True, level[1:] != level[:-1]]
                at = np.flatnonzero(first)
                size = np.diff(np.r_[at, len(level)])
                key = np.stack([level[at], size], axis=1)
                renamed = size > 1
            else:
                side = self.sides(level, step)
                opens = np.r_[(~side[:-1]) & side[1:], False]
                at = np.flatnonzero(~np.r_[False, opens[:-1]])
                renamed = opens[at]
                key = np.stack([level[at], level[np.minimum(at + 1, len(level) - 1)]], axis=1)
            step += 1
            if not renamed.any():
                continue
            names, which = np.unique(key[renamed], axis=0, return_inverse=True)
            new = level[at].copy()
            new[renamed] = fresh + which.ravel()
            fresh += len(names)
            starts = np.r_[starts[at], n]
            level = new
            self.keep(level, starts)

    @staticmethod
    def sides(level: np.ndarray, step: int) -> np.ndarray:
        """True for symbols of the right side; at least a quarter of the neighbours fall into a pair on average."""
        mixed = (level.astype(np.uint64) + np.uint64(step)) * MIX
        mixed ^= mixed >> np.uint64(29)
        return ((mixed * MIX) >> np.uint64(63)).astype(bool)

    def keep(self, level: np.ndarray, starts: np.ndarray) -> None:
        """Symbols, their starts, and for every start its place; held as lists, read one at a time."""
        self.levels.append((level.tolist(), starts.tolist(), {s: i for i, s in enumerate(starts.tolist())} if len(self.levels) else None))

    def forward(self, i: int, j: int) -> int:
        """Length of the longest common prefix of the suffixes at i < j."""
        levels = self.levels
        n = levels[0][1][-1]
        height, at = 0, i
        while j < n:
            symbols, starts, places = levels[height]
            a, b = (i, j) if places is None else (places[i], places[j])
            if symbols[a] == symbols[b]:
                # as far up as both stand at the start of equal symbols
                while height + 1 < len(levels):
                    symbols_up, _, up = levels[height + 1]
                    u, v = up.get(i), up.get(j)
                    if u is None or v is None or symbols_up[u] != symbols_up[v]:
                        break
                    height, a, b = height + 1, u, v
                _, starts, _ = levels[height]
                step = starts[a + 1] - starts[a]
                i, j = i + step, j + step
                # the next symbols start here on this level too
            elif height:
                height -= 1
            else:
                break
        return i - at


class Extensions:
    """Longest common extensions in both directions; the grammar of the reversed sequence reads backwards."""

    def __init__(self, words: np.ndarray) -> None:
        self.n = len(words)
        self.ahead, self.behind = Grammar(words), Grammar(words[::-1])

    def around(self, x: int, q: int) -> tuple[int, int]:
        """The maximal stretch with period ``q`` that holds x and x + q - 1: start, end."""
        ahead = self.ahead.forward(x, x + q)
        behind = self.behind.forward(self.n - x - q, self.n - x) if x else 0
        return x - behind, x + q + ahead


def grid(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(periods, points)`` in pieces, by period: every stretch of four periods q holds x and x + q for a multiple x of 3q."""
    low, most = 1, n // EXPONENT
    while low <= most:
        # points of periods from low on, as many periods as fill a piece
        high = low
        total = 0
        while high <= most and (high == low or total < PIECE):
            width = min(most, high + max(1, high // 2)) - high + 1
            total += width * (n // (3 * high) + 1)
            high += width
        periods = np.arange(low, min(high, most + 1))
        counts = -(-(n - periods) // (3 * periods))
        q = np.repeat(periods, counts)
        x = (np.arange(len(q)) - np.repeat(np.cumsum(counts) - counts, counts)) * 3 * q
        yield q, x
        low = high


def candidates(words: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``(period, points)`` of the grid next to which ``SIDE`` words and those one period on agree, by period."""
    n = len(words)
    for q, x in grid(n):
        ahead = np.ones(len(q), bool)
        behind = np.ones(len(q), bool)
        for k in range(SIDE):
            at = np.minimum(x + q + k, n - 1)
            ahead &= (x + q + k < n) & (words[np.minimum(x + k, n - 1)] == words[at])
            back = np.maximum(x - 1 - k, 0)
            behind &= (x - 1 - k >= 0) & (words[back] == words[np.minimum(back + q, n - 1)])
        some = np.flatnonzero(ahead | behind)
        q, x = q[some], x[some]
        if len(q):
            bounds = np.r_[0, np.flatnonzero(q[1:] != q[:-1]) + 1, len(q)].tolist()
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                yield int(q[a]), x[a:b]


def runs_of(words: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every maximal stretch of at least ``EXPONENT`` of its smallest periods and ``SHORTEST`` words.

    Periods are taken in ascending order. A point inside a known run whose period divides q can only find that run again and is passed by;
    a stretch found before has a smaller period.
    """
    found: dict[tuple[int, int], int] = {}
    lce = None
    live: list[tuple[int, int, int]] = []
    for q, points in candidates(words):
        live = [r for r in live if r[1] - r[0] > q]
        for start, end, period in live:
            if q % period == 0:
                points = points[(points < start) | (points + q >= end)]
        done = 0
        for x in points.tolist():
            # inside the stretch of this period that the point before found
            if x + q < done:
                continue
            lce = lce or Extensions(words)
            start, end = lce.around(x, q)
            done = end
            if end - start >= max(SHORTEST, EXPONENT * q) and (start, end) not in found:
                found[start, end] = q
                live.append((start, end, q))
    return sorted((s, e - s, q) for (s, e), q in found.items())


def planted(n: int, doc_id: int | None) -> np.ndarray | None:
    """For one document in ten, by a checksum of its id: the original word at each place of a text whose tail repeats; else None."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % p
    return place


def described(text: bytes, doc_id: int | None, plant: bool) -> tuple:
    words = text.split()
    place = planted(len(words), doc_id) if plant else None
    if place is not None:
        words = [words[i] for i in place.tolist()]
    known: dict[bytes, int] = {}
    numbers = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    runs = runs_of(numbers)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    if runs:
        dropped = np.cumsum(gone)[:-1] > 0
        words = [words[i] for i in np.flatnonzero(~dropped).tolist()]
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    return (
        len(runs), start, length, period, 1000 * length // period if runs else None,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest(),
    )


FIELDS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
TYPES = [*[pa.int64()] * 5, pa.string(), pa.string()]


def find_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256`` for every row.

    A run is a stretch of consecutive words with smallest period q, at least four periods and six words long, that no neighbouring
    word extends. Reported are the longest (ties: smallest start, then period), all of them as a digest, and a digest of the text in which
    each run keeps only its first period. Words are compared as they are, cut at ASCII white space. A null text counts as empty and has none.
    With ``plant``, the tail of one document in ten is made to repeat first, by a checksum of its id (a null id: never).
    Rows are judged one by one; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column(0).to_pylist()
            rows = [described(t.as_py() or b"", i, plant) for i, t in zip(ids, batch.column(1).cast(pa.binary()), strict=True)]
            columns = list(zip(*rows, strict=True)) or [()] * len(TYPES)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, TYPES, strict=True)]], ["doc_id", *FIELDS]
            )

    schema = "doc_id long, " + ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in zip(FIELDS, TYPES, strict=True))
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
