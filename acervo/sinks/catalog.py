"""Writers on catalog tables. A namespace is a catalog schema."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.functions.nested import truthy
from acervo.operators import merge
from acervo.operators.dedup import first_per_key
from acervo.operators.quality import assert_unique
from acervo.session import materialise, scratch_run
from acervo.sources.tables import table_names

log = logging.getLogger(__name__)

# Tables copied as they are next to a country cut.
AUXILIARY = (
    "concepts",
    "funders",
    "institutions",
    "publishers",
    "sources",
    "domains",
    "fields",
    "subfields",
    "topics",
)


def row_count(spark: SparkSession, table: str, estimate: bool = False) -> int:
    """Exact number of rows, or the one of the last table statistics when an
    estimate is enough and statistics exist."""
    if estimate:
        facts = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Statistics'").first()
        found = re.search(r"(\d+) rows", facts["data_type"]) if facts else None
        if found:
            return int(found.group(1))
    return spark.table(table).count()


def truncate_and_load(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").saveAsTable(table)


def append_load(df: DataFrame, table: str) -> None:
    df.write.mode("append").saveAsTable(table)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    if not spark.catalog.tableExists(table):
        return []
    return [f.name for f in spark.catalog.listColumns(table) if f.isPartition]


def rename_table(spark: SparkSession, table: str, name: str) -> None:
    """Rename; a catalog may leave the partitions of a moved table at the old place, so they are found again."""
    layout = partition_columns(spark, table)
    spark.sql(f"ALTER TABLE {table} RENAME TO {name}")
    if layout:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")


def build_then_swap(df: DataFrame, table: str, partition_by: Sequence[str] | None = None) -> None:
    """Write next to the table, then put it in its place; the partitioning is the table's own unless named.

    ``df`` may read ``table``. A leftover of an interrupted run is overwritten. The old table is moved aside by a rename and
    dropped last, so its rows are there until the new one has its name; a run that finds only the old one moves it back.
    """
    spark = df.sparkSession
    building, old = f"{table}__building", f"{table}__old"
    layout = partition_columns(spark, table) if partition_by is None else list(partition_by)
    spark.sql(f"DROP TABLE IF EXISTS {building}")
    df.write.mode("overwrite").partitionBy(*layout).saveAsTable(building)
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    if spark.catalog.tableExists(table):
        rename_table(spark, table, old)
    rename_table(spark, building, table)
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def mend_swap(spark: SparkSession, table: str) -> bool:
    """After an interrupted swap: put the old table back if the new one has not taken its name yet."""
    if spark.catalog.tableExists(table) or not spark.catalog.tableExists(f"{table}__old"):
        return False
    rename_table(spark, f"{table}__old", table)
    return True


def one_per_key(source: DataFrame, keys: Sequence[str], order: Sequence[Column] | None) -> DataFrame:
    """Source rows with unique keys: the first in ``order``, or without an order the rows as they are if no key repeats."""
    if order is not None:
        return first_per_key(source, list(keys), list(order))
    assert_unique(source, keys)
    return source


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace exactly the partitions that ``df`` has rows for; ``df`` may read the table.

    ``insertInto`` takes the mode from the session only, so it is set for this call.
    """
    spark = df.sparkSession
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        df.select(*[f"`{name}`" for name in spark.table(table).columns]).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def _current(spark: SparkSession, table: str, like: DataFrame) -> DataFrame:
    mend_swap(spark, table)
    return spark.table(table) if spark.catalog.tableExists(table) else like.limit(0)


def touched_partitions(target: DataFrame, source: DataFrame, keys: Sequence[str], layout: Sequence[str]) -> DataFrame:
    """Distinct ``layout`` values that source rows bring, or under which their keys are stored; only those columns are read."""
    stored = target.select(*dict.fromkeys([*keys, *layout])).join(source.select(*keys), list(keys), "left_semi")
    return stored.select(*layout).union(source.select(*layout)).distinct()


def _merge_into(source: DataFrame, table: str, keys: Sequence[str], merged: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    """Put ``merged(target, source)`` in the table's place, rewriting only the partitions that source rows touch.

    A table without partitions, one that gets new columns, and one of whose partitions more than half are touched is
    swapped as a whole. Otherwise the new rows of the touched partitions are written aside, then each replaces
    its partition, and those whose rows have all moved are dropped. A run that breaks off between leaves some
    partitions old; the same run again completes them.
    """
    spark = source.sparkSession
    target = _current(spark, table, source)
    layout = partition_columns(spark, table)
    if not layout or set(source.columns) - set(target.columns) or set(layout) - set(source.columns):
        build_then_swap(merged(target, source), table)
        return
    with scratch_run(spark):
        source = materialise(source, "table-source")
        # as many values as partitions, which the catalog holds anyway
        touched = [tuple(row) for row in touched_partitions(target, source, keys, layout).toLocalIterator()]
        if not touched:
            return
        if 2 * len(touched) > spark.sql(f"SHOW PARTITIONS {table}").count():
            build_then_swap(merged(target, source), table)
            return
        fresh = materialise(merged(target.where(_in_partitions(layout, touched)), source), "table-partitions")
        filled = {tuple(row) for row in fresh.select(*layout).distinct().toLocalIterator()}
        overwrite_partitions(fresh, table)
        drop_partitions(spark, table, [dict(zip(layout, values, strict=True)) for values in touched if values not in filled])


def _in_partitions(layout: Sequence[str], values: Sequence[tuple]) -> Column:
    """Test for one of the partitions, by lists of the last column's values, so that the scan reads no others."""
    groups: dict[tuple, list] = {}
    for *head, last in values:
        groups.setdefault(tuple(head), []).append(last)
    tests = []
    for head, lasts in groups.items():
        test = F.col(layout[-1]).isin([v for v in lasts if v is not None])
        if None in lasts:
            test = test | F.col(layout[-1]).isNull()
        tests.append(reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.lit(v)) for n, v in zip(layout, head, strict=False)], test))
    # halves, so that the depth grows with the logarithm of their number
    while len(tests) > 1:
        tests = [a | b for a, b in zip(tests[::2], tests[1::2], strict=False)] + tests[len(tests) // 2 * 2 :]
    return tests[0]


def upsert_table(source: DataFrame, table: str, keys: Sequence[str], order: Sequence[Column] | None = None, **rules) -> None:
    """Field-level upsert. Of source rows of one key the first in ``order`` counts; without an order they are an error."""
    _merge_into(one_per_key(source, keys, order), table, keys, lambda target, rows: merge.upsert(target, rows, keys, **rules))


def replace_rows_table(source: DataFrame, table: str, keys: Sequence[str], order: Sequence[Column] | None = None) -> None:
    """Whole-row replace; a row whose partition changes moves."""
    _merge_into(one_per_key(source, keys, order), table, keys, lambda target, rows: merge.replace_rows(target, rows, keys))


def keep_existing_table(source: DataFrame, table: str, keys: Sequence[str], order: Sequence[Column] | None = None) -> None:
    """Only the missing rows are written; the stored files stay as they are."""
    source = one_per_key(source, keys, order)
    target = _current(source.sparkSession, table, source)
    layout = partition_columns(source.sparkSession, table)
    fresh = source.join(target.select(*keys), list(keys), "left_anti").select(*source.columns)
    fresh.write.mode("append").partitionBy(*layout).saveAsTable(table)


def partition_spec(values: dict[str, object]) -> str:
    """SQL for one partition; a null value lies in the default partition, quotes and backslashes are escaped."""
    parts = []
    for name, value in values.items():
        text = str(value).replace(chr(92), chr(92) * 2).replace(chr(39), chr(92) + chr(39))
        parts.append(f"`{name}` = NULL" if value is None else f"`{name}` = '{text}'")
    return f"PARTITION ({', '.join(parts)})"


def drop_partitions(spark: SparkSession, table: str, partitions: Sequence[dict[str, object]]) -> None:
    """In one statement for up to a hundred of them."""
    for at in range(0, len(partitions), 100):
        specs = ", ".join(partition_spec(values) for values in partitions[at : at + 100])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")


def replace_partitions(source: DataFrame, table: str, group: str, groups: DataFrame) -> None:
    """Replace all rows of the named groups in a table partitioned by ``group``, a null group included.

    Only those partitions are written, and a named group without rows is emptied, after the others are in place.
    """
    spark = source.sparkSession
    named = groups.select(F.col(group).alias("__group")).distinct()
    incoming = source.join(named, source[group].eqNullSafe(F.col("__group")), "left_semi")
    if not spark.catalog.tableExists(table):
        incoming.write.partitionBy(group).saveAsTable(table)
        return
    # group names number as many as partitions, which the catalog holds anyway
    present = incoming.select(F.col(group).alias("__there")).distinct()
    empty = [value for (value,) in named.join(present, F.col("__group").eqNullSafe(F.col("__there")), "left_anti").toLocalIterator()]
    overwrite_partitions(incoming, table)
    drop_partitions(spark, table, [{group: value} for value in empty])


def load_by_content(documents: DataFrame, table: str, key: str = "id", order: str = "position") -> str:
    """Replace by key when every document has a truthy key, else truncate and load.

    ``documents`` has a ``raw`` VARIANT and an ``order`` column; returns the way taken.
    """
    keyed = documents.withColumn("__key", F.try_variant_get("raw", f"$.{key}", "string"))
    ok = F.bool_and(truthy(F.try_variant_get("raw", f"$.{key}", "variant")))
    verdict = keyed.agg(ok.alias("all_keyed")).first()["all_keyed"]
    if verdict is None:
        return "empty"
    if not verdict:
        truncate_and_load(documents.select("raw"), table)
        return "truncate"
    rows = first_per_key(keyed, ["__key"], [F.col(order).desc()])
    replace_rows_table(rows.select(F.col("__key").alias(key), "raw"), table, [key])
    return "replace"


def copy_tables(spark: SparkSession, source: str, target: str, names: Sequence[str], drop: Sequence[str] = ()) -> None:
    """Verbatim copies, several jobs at a time; existing copies are replaced."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {target}")

    def copy(name: str) -> None:
        truncate_and_load(spark.table(f"{source}.{name}").drop(*drop), f"{target}.{name}")

    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(copy, names))


def copy_auxiliary(spark: SparkSession, source: str, target: str) -> list[str]:
    """Copy the auxiliary tables that exist; returns their names."""
    present = [n for n in AUXILIARY if spark.catalog.tableExists(f"{source}.{n}")]
    copy_tables(spark, source, target, present)
    return present


def backup(spark: SparkSession, table: str, run_time: datetime) -> str | None:
    """Copy a non-empty table to ``<table>_backup_<stamp>``. A failure is logged only."""
    if not spark.catalog.tableExists(table) or spark.table(table).isEmpty():
        return None
    name = f"{table}_backup_{run_time:%Y%m%d_%H%M%S}"
    try:
        truncate_and_load(spark.table(table), name)
    except Exception:
        log.exception("backup of %s failed", table)
        return None
    return name


def archive(spark: SparkSession, namespace: str, run_time: datetime) -> str | None:
    """Move a namespace to ``<namespace>_<yyyymm>``; a second run that month overwrites it."""
    if not spark.catalog.databaseExists(namespace):
        return None
    names = table_names(spark, namespace)
    if not names:
        return None
    target = f"{namespace}_{run_time:%Y%m}"
    copy_tables(spark, namespace, target, names, drop=["_id"])
    spark.sql(f"DROP DATABASE {namespace} CASCADE")
    return target


def export(df: DataFrame, folder: str, prefix: str, run_time: datetime, fmt: str = "parquet") -> str | None:
    """Write a non-empty table to ``<folder>/<prefix>_<stamp>``; its path, or None."""
    if df.isEmpty():
        return None
    path = f"{folder.rstrip('/')}/{prefix}_{run_time:%Y%m%d_%H%M%S}"
    df.write.format(fmt).save(path)
    return path


def reset(spark: SparkSession, namespace: str) -> None:
    """Drop a namespace with its data and its checkpoint table."""
    spark.sql(f"DROP DATABASE IF EXISTS {namespace} CASCADE")
    spark.sql(f"CREATE DATABASE {namespace}")


def clean_surplus(spark: SparkSession, table: str, year: int, key: str, order: Sequence[str], expected: int) -> str:
    """Compare a year's row count with the expected one; when there are more, keep the
    first row per key, rewriting only that year's partition."""
    part = spark.table(table).where(F.col("year") == year)
    actual = part.count()
    if actual <= expected:
        return "match" if actual == expected else "fewer"
    overwrite_partitions(first_per_key(part, [key], [F.col(f"`{c}`") for c in order]), table)
    return "clean"
