"""Mix sources to target weights, exactly to the word, without a driver-side loop over documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acervo.operators.positions import row_positions
from acervo.session import materialise

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: No document is used more often than this.
MAX_EPOCHS = 3
#: Rows of one key range of a source: what a task sorts at once.
RANGE_ROWS = 16_384


def word_count(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, n_rows, weight, target`` per source.

    Sources rank by code point, a null source last, and take ``weights`` in turn. Together they are to reach the words
    of all sources. A target stops at ``most`` times its source; what is over goes to the others by weight. Each round
    is one aggregate over the sources, and fixes the sources that the last level put above their stop.
    """
    kinds = materialise(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows")), "mix-sources")
    ranked = row_positions(kinds, [F.col("source").isNull(), F.col("source")], alias="place")
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = ranked.select("source", "source_size", "n_rows", turn.cast("long").alias("weight"))
    stop = F.col("source_size") * most
    total = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    left, open_weight, known = total, ranked.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0], -1
    while True:
        above = _above(stop, left, open_weight)
        row = ranked.agg(
            F.coalesce(F.sum(F.when(above, stop)), F.lit(0)),
            F.coalesce(F.sum(F.when(above, F.col("weight"))), F.lit(0)),
            F.coalesce(F.sum("weight"), F.lit(0)),
        ).first()
        if row[1] == known:
            break
        known, left, open_weight = row[1], total - row[0], row[2] - row[1]
        if open_weight == 0:
            break
    share = F.col("weight").cast("double") * F.lit(float(left)) / F.lit(float(open_weight or 1))
    above = _above(stop, left, open_weight)
    return ranked.withColumn("target", F.when(above, stop.cast("double")).otherwise(share))


def _above(stop: Column, left: int, open_weight: int) -> Column:
    """Whether a source's share of the words left lies above its stop."""
    return F.col("weight").cast("double") * F.lit(float(left)) > stop.cast("double") * F.lit(float(open_weight))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS, seed: str = "mix") -> DataFrame:
    """How much of every document the mix takes: ``doc_id, source, size, source_size, target, taken, text_hash``.

    Documents get a random key from a hash of their id and are sorted by it within their source. A source gives its
    target, rounded down to a word: whole passes first, then documents in key order until the budget is used; the
    last one gives its first words only. The key range of a source is cut into even parts, so that a source that holds
    most rows is sorted by many tasks; sums of the parts place them. Reruns agree.

    A null text has no words, a null source is a source, a null id sorts first. Rows that agree in id and size
    are alike; which of them the budget cuts is settled by a hash of the text. Extra columns are ignored.
    """
    sizes = materialise(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash")), "mix-sizes")
    targets = materialise(source_targets(sizes, weights, most), "mix-targets")
    plan = targets.select(
        F.col("source").alias("_source"), "source_size", "target",
        F.ceil(F.col("n_rows") / RANGE_ROWS).alias("_parts"),
        F.floor("target").cast("long").alias("_budget"),
    )
    joined = sizes.join(plan, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    #: 48 of the key's 128 bits say in which part of the range it lies.
    place = F.conv(F.substring("_key", 1, 12), 16, 10).cast("long")
    joined = joined.withColumn("_key", key).withColumn("_part", F.floor(place.cast("double") / float(1 << 48) * F.col("_parts")).cast("long"))
    sums = joined.groupBy("source", "_part").agg(F.sum("size").alias("_words"))
    before = W.partitionBy("source").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("_source"), F.col("_part").alias("_p"), F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_start")
    )
    inside = W.partitionBy("source", "_part").orderBy("_key", "doc_id", "size", "text_hash").rowsBetween(W.unboundedPreceding, -1)
    placed = joined.withColumn("_within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_part") == F.col("_p")), "left")
    passes = F.expr("_budget DIV greatest(source_size, 1)")
    rest = F.col("_budget") - passes * F.col("source_size")
    last = F.least(F.col("size"), F.greatest(F.lit(0), rest - F.col("_start") - F.col("_within")))
    return placed.select("doc_id", "source", "size", "source_size", "target", (passes * F.col("size") + last).cast("long").alias("taken"), "text_hash")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS, seed: str = "mix") -> DataFrame:
    """The rows of ``docs`` as the mix uses them: repeated once for each pass, the last one cut after its last word taken.

    A document without words has nothing to give and stays out. Rows equal in id, source and text share what is taken
    of them evenly, rounded down to a word.
    """
    use = mix(docs, weights, most, seed).groupBy("doc_id", "source", "size", "text_hash").agg(F.floor(F.avg("taken")).cast("long").alias("_taken")).where("_taken > 0")
    use = use.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("text_hash").alias("_hash"), "_taken")
    met = docs.join(use, (F.xxhash64(docs["text"]) == use["_hash"]) & docs["doc_id"].eqNullSafe(use["_id"]) & docs["source"].eqNullSafe(use["_source"]))
    whole, some = F.floor(use["_taken"] / use["_size"]).cast("int"), use["_taken"] % use["_size"]
    gives = F.concat(F.array_repeat(use["_size"], whole), F.filter(F.array(some), lambda n: n > 0))
    used = met.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), use["_size"].alias("size"), F.explode(gives).alias("give"))
    text = F.when(F.col("give") == F.col("size"), F.col("doc.text")).otherwise(first_words(F.col("doc.text"), F.col("give")))
    return used.select(*[text.alias(c) if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns])


def first_words(text: Column, n: Column) -> Column:
    """``text`` up to the end of its ``n``-th word."""
    ends = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    return F.array_join(F.slice(ends, F.lit(1), n.cast("int")), "")
