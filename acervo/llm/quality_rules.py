"""Quality rules: a decision list learned from labelled documents, applied as one Spark conditional expression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from acervo.llm.arrow import slices
from acervo.session import materialise

#: Words of a window that may repeat.
WINDOW = 8
#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
#: Labelled documents that the rules are learned from, about, by a hash of their id: the bound of the fit.
TRAIN_ROWS = 40_000
#: A rule of rejection must be right for so many of the documents it covers, and cover so many bad ones.
PRECISION = 0.99
SUPPORT = 5
MAX_RULES = 24
MAX_CONDITIONS = 3
#: Thresholds tried for a feature in one condition.
CUTS = 64
#: Share of the training rows on which rules grow; on the others they are pruned.
GROW = 2 / 3

COUNTS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_digits long, n_stops long, n_distinct long"

#: Features of the rules, from the counts.
FEATURES = {
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbol_rate": "n_symbols / greatest(n_words, 1)",
    "dup_line_rate": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_rate": "n_repeat_words / greatest(n_words, 1)",
    "upper_rate": "n_upper / greatest(word_chars, 1)",
    "digit_rate": "n_digits / greatest(word_chars, 1)",
    "stop_rate": "n_stops / greatest(n_words, 1)",
    "distinct_rate": "n_distinct / greatest(n_words, 1)",
    "words_a_line": "n_words / greatest(n_lines, 1)",
}


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window found at two places or more, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(window):
        key = key * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    # equal windows have equal keys; what shares a key is compared itself
    maybe = np.unique(np.concatenate([order[1:][same], order[:-1][same]])).tolist()
    seen: dict[tuple, int] = {}
    twice = []
    for i in maybe:
        w = tuple(words[i : i + window])
        first = seen.setdefault(w, i)
        if first != i:
            twice += [first, i]
    if not twice:
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.unique(twice)
    edge[at] += 1
    edge[at + window] -= 1
    return int((np.cumsum(edge) > 0).sum())


def counts_of(text: bytes) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS`` after doc_id; words are runs of non-white ASCII space."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    chars = np.frombuffer(text, np.uint8)
    points = int(((chars & 0xC0) != 0x80).sum())
    return (
        len(words),
        points - sum(text.count(bytes([c])) for c in SPACES),
        sum(text.count(bytes([c])) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        int(((chars >= 65) & (chars <= 90)).sum()),
        int(((chars >= 48) & (chars <= 57)).sum()),
        text.count(b".") + text.count(b"!") + text.count(b"?"),
        len(set(words)),
    )


def measure(docs: DataFrame) -> DataFrame:
    """The counts of every whole text, one row per row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in COUNTS.split(", ")]
        for batch in slices(batches):
            rows = [counts_of(t.as_py() or b"") for t in batch.column(1).cast(pa.binary())]
            columns = np.array(rows, np.int64).reshape(-1, len(names) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(columns[:, k]) for k in range(columns.shape[1])]], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, COUNTS)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > self.cut if self.above else value <= self.cut

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.cut if self.above else x[self.feature] <= self.cut


Rule = tuple[Condition, ...]


def _covered(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    hit = np.ones(n, bool)
    for c in rule:
        hit &= c.holds(x)
    return hit


def _grow(x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Conditions added one at a time, each the one of most information gained per bad row still covered."""
    rule: Rule = ()
    hit = np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS:
        p0, n0 = (hit & bad).sum(), (hit & ~bad).sum()
        if not p0 or not n0:
            break
        best: tuple[float, Condition | None] = (1e-9, None)
        for name, v in x.items():
            inside = v[hit]
            cuts = np.unique(np.quantile(inside, np.linspace(0, 1, CUTS + 1)[1:-1], method="lower"))
            wrong = np.sort(v[hit & bad])
            right = np.sort(v[hit & ~bad])
            below = np.searchsorted(wrong, cuts, "right"), np.searchsorted(right, cuts, "right")
            for above in (True, False):
                p, n = (p0 - below[0], n0 - below[1]) if above else below
                gain = np.where(p > 0, p * (np.log2((p + 1e-12) / (p + n + 1e-12)) - np.log2(p0 / (p0 + n0))), 0)
                k = int(np.argmax(gain)) if len(gain) else 0
                if len(gain) and gain[k] > best[0]:
                    best = (float(gain[k]), Condition(name, above, float(cuts[k])))
        if best[1] is None:
            break
        found = best[1]
        # half way to the next value seen, so that the edge of the sample is not the edge of the rule
        inside = x[found.feature][hit]
        beyond = inside[inside > found.cut]
        if len(beyond):
            found = Condition(found.feature, found.above, float((found.cut + beyond.min()) / 2))
        rule += (found,)
        hit &= found.holds(x)
    return rule


def learn(x: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Sequential covering: grow a rule on one part, prune it on the other, remove what it covers, and go on.

    A rule that is not right often enough on either part ends the list, as the best one left is then no better than chance.
    """
    n = len(bad)
    grown = np.arange(n) % 12 < round(12 * GROW)
    left = np.ones(n, bool)
    rules: list[Rule] = []
    while len(rules) < MAX_RULES and (left & bad & grown).sum() >= SUPPORT:
        part = {k: v[left & grown] for k, v in x.items()}
        rule = _grow(part, bad[left & grown])

        def worth(r: Rule) -> float:
            hit = _covered(r, x, n) & left & ~grown
            p, q = (hit & bad).sum(), (hit & ~bad).sum()
            return (p - q) / (p + q) if p + q else -1.0

        while len(rule) > 1 and (shorter := max((tuple(c for c in rule if c is not d) for d in rule), key=worth)) and worth(shorter) >= worth(rule):
            rule = shorter
        hit = _covered(rule, x, n) & left
        if not rule or not hit.any():
            break
        if (hit & bad).sum() < SUPPORT or (hit & bad).sum() < PRECISION * hit.sum():
            break
        rules.append(rule)
        left &= ~hit
    return rules


def rejected_by(rules: list[Rule]) -> Column:
    """Number of the first rule that covers a document, from 1; null if none does."""
    case = None
    for i, rule in enumerate(rules, 1):
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        case = F.when(test, F.lit(i)) if case is None else case.when(test, F.lit(i))
    return F.lit(None).cast("int") if case is None else case


def fit(measured: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> list[Rule]:
    """Rules from the labelled documents that pass the base: quality 0 is bad; about ``rows`` of them, by a hash of the id.

    Labels that are null, or contradict each other for an id, are left out; of rows with one id the one with the greatest features counts.
    """
    clear = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most").drop("most")
    share = min(1.0, rows / max(1, clear.count()))
    # a share by hash: no task sends the driver more than its part of the sample
    clear = clear.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    features = [F.expr(e).cast("double").alias(k) for k, e in FEATURES.items()]
    known = measured.where(~base_failed()).join(clear, "doc_id").select("doc_id", "quality", *features)
    # an id that many rows carry gives one example
    known = known.groupBy("doc_id", "quality").agg(F.max(F.struct(*FEATURES)).alias("f")).select("doc_id", "quality", "f.*")
    got = known.toPandas().sort_values(["doc_id", *FEATURES], kind="stable")
    got = got.iloc[np.argsort(got["doc_id"].to_numpy() * np.int64(0x9E3779B97F4A7C1) & np.int64(0x7FFFFFFF), kind="stable")]
    return learn({k: got[k].to_numpy(float) for k in FEATURES}, got["quality"].to_numpy() == 0)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Counts of every document with ``base_failed``, ``rule`` (the one that rejects it) and ``kept``.

    Base: fewer than 20 words, or over 30 % of the words in repeated windows. Then the learned list decides: a
    document that no rule covers is kept, so without labels nothing but the base rejects. A null text has no words and fails the base.
    Rows with one id are judged each by its own text. Columns besides doc_id and text are ignored.
    """
    measured = materialise(measure(docs), "quality-counts")
    rules = fit(measured, labels, rows)
    return measured.select("*", base_failed().alias("base_failed"), rejected_by(rules).alias("rule")).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep_good(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that are kept, as they are: the counts ride along with each row instead of being joined to it."""
    # the rules are learned from labelled documents, so only those are measured for it
    labelled = docs.select("doc_id", "text").join(labels.select("doc_id").where("doc_id is not null").distinct(), "doc_id", "left_semi")
    rules = fit(measure(labelled), labels, rows)
    names = [part.split()[0] for part in COUNTS.split(", ")][1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts = np.array([counts_of(t.as_py() or b"") for t in batch.column("words").cast(pa.binary())], np.int64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([batch.column("row"), *[pa.array(counts[:, k]) for k in range(len(names))]], ["row", *names])

    # a row is one value beside the counts, whatever its columns are called
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("words"))
    schema = StructType([whole.schema["row"], *[StructField(n, LongType()) for n in names]])
    judged = whole.mapInArrow(run, schema)
    return judged.where(~base_failed() & rejected_by(rules).isNull()).select("row.*")
