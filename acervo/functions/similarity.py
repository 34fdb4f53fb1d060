"""Title and author similarity, 0 to 100, as Arrow-batched UDFs.

The scores are our own definitions. Indel ratio is ``100 * 2*LCS / (len a + len b)``,
rounded, 0 for two empty texts. They run on the few candidates per title that
retrieval leaves, never on all pairs.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Author score and title scores from which a pair counts as the same work.
AUTHOR_MATCH = 65
TITLE_WITH_AUTHOR = 90
TITLE_ALONE = 94


def _lcs_against(pattern: str) -> Callable[[str], int]:
    """Longest common subsequence with ``pattern``, one machine step per letter of the other text."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(pattern):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(pattern)) - 1

    def length(text: str) -> int:
        state = full
        for ch in text:
            hit = state & masks.get(ch, 0)
            state = ((state + hit) | (state - hit)) & full
        return len(pattern) - state.bit_count()

    return length


def lcs_length(a: str, b: str) -> int:
    return _lcs_against(a)(b) if len(a) <= len(b) else _lcs_against(b)(a)


def _ratio(a: str, b: str, floor: float = 0.0) -> float:
    """Indel ratio, or 0 when the lengths alone keep it below ``floor``."""
    total = len(a) + len(b)
    if total == 0 or 200.0 * min(len(a), len(b)) / total < floor:
        return 0.0
    return 200.0 * lcs_length(a, b) / total


def _partial(a: str, b: str, floor: float = 0.0) -> float:
    """Best Indel ratio of the shorter text against equal-length windows of the
    longer, or 0 when none reaches ``floor``.

    Moving a window by one letter changes its LCS by at most one, so between two
    windows i and j no LCS exceeds half of their sum plus j - i. Stretches are
    halved in the order of that bound until none can beat the best: exact.
    """
    if len(a) > len(b):
        a, b = b, a
    n = len(a)
    if n == 0:
        return 0.0
    if a in b:
        return 100.0
    lcs = _lcs_against(a)
    marks = sorted({*range(0, len(b) - n, max(3 * n // 4, 1)), len(b) - n})
    values = [lcs(b[at : at + n]) for at in marks]
    # the score to beat: the best so far, or the largest one below the floor
    best = max(max(values), math.ceil(floor * n / 100.0) - 1)
    stretches: list[tuple[int, int, int, int, int]] = []

    def push(i: int, left: int, j: int, right: int) -> None:
        bound = min((left + right + j - i) // 2, n)
        if j - i > 1 and bound > best:
            heapq.heappush(stretches, (-bound, i, left, j, right))

    for at in range(len(marks) - 1):
        push(marks[at], values[at], marks[at + 1], values[at + 1])
    while stretches and -stretches[0][0] > best:
        _, i, left, j, right = heapq.heappop(stretches)
        middle = (i + j) // 2
        value = lcs(b[middle : middle + n])
        best = max(best, value)
        push(i, left, middle, value)
        push(middle, value, j, right)
    score = 100.0 * best / n
    return score if score >= floor else 0.0


def _token_sort(a: list[str], b: list[str], floor: float) -> float:
    lengths = [sum(map(len, words)) + len(words) - 1 for words in (a, b)]
    if 200.0 * min(lengths) / sum(lengths) < floor:
        return 0.0
    return _ratio(" ".join(sorted(a)), " ".join(sorted(b)), floor)


def _token_set(a: list[str], b: list[str], floor: float) -> float:
    """Best ratio among the shared tokens and the two token sets, shared tokens first."""
    left, right = set(a), set(b)
    common = " ".join(sorted(left & right))
    with_left = " ".join(filter(None, [common, " ".join(sorted(left - right))]))
    with_right = " ".join(filter(None, [common, " ".join(sorted(right - left))]))
    # the shared tokens start both texts, so their LCS with either is their length
    of_common = [200.0 * len(common) / (len(common) + len(w)) for w in (with_left, with_right) if common]
    return max([*of_common, _ratio(with_left, with_right, floor)])


def title_score(a: str, b: str, floor: int = 0) -> int:
    """Highest of ratio, 0.95 token sort, 0.95 token set and, for lengths that
    differ by a factor of 1.5 or more, 0.9 partial; rounded.

    With a ``floor`` the score is exact from the floor on, and some smaller
    number below it; parts that cannot reach the floor are not computed.
    """
    words_a, words_b = a.split(), b.split()
    if not words_a or not words_b:
        return 0
    need = max(floor - 0.5, 0.0)
    best = max(
        _ratio(a, b, need),
        0.95 * _token_sort(words_a, words_b, need / 0.95),
        0.95 * _token_set(words_a, words_b, need / 0.95),
    )
    if max(len(a), len(b)) >= 1.5 * min(len(a), len(b)) and best < 90.0:
        best = max(best, 0.9 * _partial(a, b, max(need, best) / 0.9))
    return round(best)


def author_score(a: str, b: str) -> int:
    return round(_partial(a, b)) if a and b else 0


@F.pandas_udf(T.IntegerType())
def _title_udf(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for left, right, floors in batches:
        scores = [title_score(a or "", b or "", floor) for a, b, floor in zip(left, right, floors, strict=True)]
        yield pd.Series(scores, dtype="int32")


@F.pandas_udf(T.IntegerType())
def _author_udf(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for first, names in batches:
        yield pd.Series(
            [
                max((author_score(a, n) for n in (ns if ns is not None else ()) if n), default=0) if a else 0
                for a, ns in zip(first, names, strict=True)
            ],
            dtype="int32",
        )


def title_similarity(a: Column, b: Column, floor: int = 0) -> Column:
    """Score of two folded titles, exact from ``floor`` on."""
    return _title_udf(a, b, F.lit(floor))


def author_similarity(author: Column, names: Column) -> Column:
    """Best partial score of a folded author name against a list of folded names."""
    return _author_udf(author, names)


def accepted(title: Column, author: Column) -> Column:
    """Same work: 90 or more when the author matches (65 or more), else 94 or more."""
    needed = F.when(author >= AUTHOR_MATCH, TITLE_WITH_AUTHOR).otherwise(TITLE_ALONE)
    return F.coalesce(title >= needed, F.lit(False))
