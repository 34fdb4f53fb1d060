"""Semi-joins, probes, lookups and closures.

No side that grows with the input is broadcast by hint: adaptive execution measures each
side and broadcasts it only below ``spark.sql.autoBroadcastJoinThreshold``; beyond that
the join is a shuffled one, with skewed partitions of the left side split. Key
sets on the right are made distinct first, on the map side, so that a key with many
rows there is one row before it moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.operators.dedup import first_per_key
from acervo.session import materialise


def ids_by_nested_key(rows: DataFrame, id_col: str, array: Column, keys: DataFrame, key: str) -> DataFrame:
    """Distinct ids of rows with any array value in ``keys``. Only (id, value) pairs move, and of these only those whose value may be a key."""
    pairs = rows.select(id_col, F.explode(F.array_distinct(array)).alias(key)).where(F.col(key).isNotNull())
    keys = materialise(keys.select(key).distinct(), "nested-keys")
    # values of another type than the keys have other hashes
    if pairs.schema[key].dataType == keys.schema[key].dataType:
        pairs = possible(pairs, key, materialise(id_bitmaps(keys, key), "nested-bitmaps"))
    return pairs.join(keys, key, "left_semi").select(id_col).distinct()


#: Bits of the set that ``possible`` tests: 4 MB at most, with the numbers of their words 8 MB.
SET_BITS = 1 << 25


def _spot(key: str) -> tuple[Column, Column]:
    """The word of 64 bits in which the hash of a key has its bit, and the place of the bit."""
    spot = F.pmod(F.xxhash64(key), F.lit(SET_BITS))
    return F.shiftright(spot, 6), spot.bitwiseAND(F.lit(63)).cast("int")


def id_bitmaps(ids: DataFrame, key: str) -> DataFrame:
    """``word_no, bits``: a bit for the hash of every id, at most SET_BITS / 64 words however many ids there are."""
    word, bit = _spot(key)
    spots = ids.select(word.alias("word_no"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit"))
    return spots.groupBy("word_no").agg(F.bit_or("bit").alias("bits"))


def marked(rows: DataFrame, key: str, bitmaps: DataFrame) -> DataFrame:
    """``rows`` with ``__maybe``: whether the key may be one of the ids that ``bitmaps`` was made of; never false for one that is.

    The bitmaps are small whatever the ids number, so they are sent to the scan of ``rows`` and tested there, before anything moves.
    """
    word, bit = _spot(key)
    there = F.call_function("shiftright", F.col("__bits"), bit).bitwiseAND(F.lit(1)) == 1
    # of bounded size: sent even where the threshold for broadcasts is lower, since the exchange of all rows is what they save
    sent = F.broadcast(bitmaps.select(F.col("word_no").alias("__word"), F.col("bits").alias("__bits")))
    met = rows.join(sent, word == F.col("__word"), "left")
    return met.withColumn("__maybe", F.coalesce(there, F.lit(False))).drop("__word", "__bits")


def possible(rows: DataFrame, key: str, bitmaps: DataFrame) -> DataFrame:
    """Rows whose key may be one of the ids that ``bitmaps`` was made of; none that is one is lost."""
    return marked(rows, key, bitmaps).where("__maybe").drop("__maybe")


#: Buckets of key hashes in which rows are counted, and rows of one key that a task takes without trouble.
BUCKETS, HOT_ROWS = 1 << 16, 100_000


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS))


def hot_buckets(rows: DataFrame, key: str) -> list[int]:
    """Buckets of key hashes with far more rows than most: those of every key that has very many, at most a quarter of all buckets."""
    counted = materialise(rows.groupBy(_bucket(key).alias("bucket")).agg(F.count(F.lit(1)).alias("n")), "key-counts")
    usual = counted.agg(F.coalesce(F.sum("n"), F.lit(0)) / BUCKETS).scalar()
    return [row["bucket"] for row in counted.where(F.col("n") > HOT_ROWS + 4 * usual).select("bucket").collect()]


def spread_join(rows: DataFrame, unique: DataFrame, on: str, salts: int = 16, hot: Sequence[int] | None = None) -> DataFrame:
    """Inner join of ``rows`` with a table that is unique on the key, for when the next
    step groups by that key again and Spark could not split a hot one.

    The rows of a key are spread by input partition, so that equal copies separate
    and a retried task sends each row to the same place; the narrow side is
    repeated once per salt. With ``hot``, the ``hot_buckets`` of the rows, only the keys in these are:
    a narrow side that is itself large is then sent once.
    """
    if hot is not None and not hot:
        return rows.join(unique, on)
    spread = F.lit(True) if hot is None else _bucket(on).isin(list(hot))
    salted = rows.withColumn("__salt", F.when(spread, F.pmod(F.spark_partition_id(), F.lit(salts))).otherwise(F.lit(0)))
    repeated = unique.withColumn("__salt", F.explode(F.when(spread, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return salted.join(repeated, [on, "__salt"]).drop("__salt")


def first_match_lookup(
    rows: DataFrame, lookup: DataFrame, on: str, fields: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Left join that takes the first lookup row per key, so rows never multiply."""
    single = first_per_key(lookup.where(F.col(on).isNotNull()), [on], order)
    return rows.join(single.select(on, *fields), on, "left")


def referenced(entities: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Entities whose key occurs in ``ids``."""
    return entities.join(ids.select(key).distinct(), key, "left_semi")


def loaded(probes: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    return probes.join(stored.select(*keys).distinct(), list(keys), "left_semi")


def pending(work: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Work that is not done: new files, changed sources, unseen triples."""
    return work.join(done.select(*keys).distinct(), list(keys), "left_anti")


def registry_lookup(rows: DataFrame, registry: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their enabled registry entry, rows whose name is unknown)."""
    known = rows.join(registry.where("enabled"), name)
    unknown = rows.join(registry.select(name), name, "left_anti")
    return known, unknown
