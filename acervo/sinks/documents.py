"""Schemaless record table: versions of records, each ``id``, ``raw`` VARIANT and where it came from.

The table is a Parquet folder of immutable deltas, one partition per batch. A load appends the rows it brings and nothing
else, so what it writes is in proportion to what it brings. What a record is follows from its versions
alone, whatever order they were loaded in: of each field the value of the latest version that has it.

A compacted table has its records in a base, a partition before all batches. A base row that is the only version of its
record is marked; unless a later batch brings its id, it is read as it is, without an exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acervo.operators.joins import id_bitmaps, marked, possible
from acervo.session import materialise, scratch_run
from acervo.sources.paths import has_files

VERSION = ["updated_date", "file_path", "line_no"]
STORED_SCHEMA = "id string, raw variant, alone boolean, updated_date date, file_path string, line_no long, batch_id long"
COLUMNS = [f.split()[0] for f in STORED_SCHEMA.split(", ")]
#: Number of the partition that a compaction writes; batches count from 0.
BASE = -1
#: Versions up to which a record is resolved in one place; one with more is reduced to its fields first.
FEW = 32


def stored_versions(spark: SparkSession, path: str) -> DataFrame:
    """All versions that are stored, with the batch that brought them."""
    if not has_files(spark, path, ".parquet"):
        return spark.createDataFrame([], STORED_SCHEMA)
    return spark.read.schema(STORED_SCHEMA).parquet(path)


def stored_documents(spark: SparkSession, path: str) -> DataFrame:
    """One record per id, resolved from its versions: ``id, raw`` and the latest version's columns.

    What is exchanged are the versions of ids that the batches after the last compaction touch, and of records
    that it left in several versions.
    """
    settled, open_ = settled_versions(spark, path)
    few, many = by_versions(open_)
    # rows without an id are no versions of each other
    rows = laid_over(few.select("id", "raw", *VERSION)).withColumn("single", F.expr("n = 1 or id is null")).where("single or size(entries) > 0")
    nth = F.row_number().over(W.partitionBy("id").orderBy(*[F.desc(v) for v in VERSION]))
    rows = rows.withColumns({"all": F.collect_list("entries").over(W.partitionBy("id")), "nth": nth}).where("single or nth = 1")
    raw = F.when(F.col("single"), F.col("raw")).otherwise(F.to_variant_object(F.map_from_entries(F.flatten("all"))))
    found = settled.select("id", "raw", *VERSION).unionByName(rows.select("id", raw.alias("raw"), *VERSION))
    return found if many is None else found.unionByName(merged_by_id(many))


def settled_versions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(base rows that are whole records, all other versions)."""
    versions = stored_versions(spark, path)
    if not has_files(spark, f"{path}/batch_id={BASE}", ".parquet"):
        return versions.limit(0), versions
    alone = F.coalesce(F.col("alone"), F.lit(False))
    others, base = versions.where(~alone), versions.where(alone)
    base = marked(base, "id", materialise(id_bitmaps(others, "id"), "touched-bitmaps"))
    return base.where("not __maybe").drop("__maybe"), base.where("__maybe").drop("__maybe").unionByName(others)


def by_versions(versions: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(versions of ids that have at most ``FEW``, those of all other ids, None if there are none)."""
    hot = versions.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > FEW).select(F.col("id").alias("hot"))
    hot = materialise(hot, "document-hot")
    if hot.isEmpty():
        return versions, None
    same = versions["id"].eqNullSafe(F.col("hot"))
    return versions.join(hot, same, "left_anti"), versions.join(hot, same, "left_semi")


def laid_over(versions: DataFrame) -> DataFrame:
    """``versions`` with ``entries``, their fields that no later version of the id has, ``whole``: these are all, and ``n``, the versions of the id.

    One exchange and one sort by id: a version needs no more than the names in the ones after it.
    """
    later = W.partitionBy("id").orderBy(*[F.desc(v) for v in VERSION]).rowsBetween(W.unboundedPreceding, -1)
    rows = versions.repartition("id").withColumn("fields", F.map_entries(F.try_variant_get("raw", "$", "map<string,variant>")))
    hidden = F.flatten(F.collect_list(F.col("fields.key")).over(later))
    rows = rows.withColumns({"hidden": hidden, "n": F.count(F.lit(1)).over(W.partitionBy("id"))})
    rows = rows.withColumn("entries", F.filter("fields", lambda f: ~F.array_contains("hidden", f["key"])))
    return rows.withColumn("whole", F.size("entries") == F.size("fields")).drop("fields", "hidden")


def merged_by_id(incoming: DataFrame) -> DataFrame:
    """One record per id: of each field the value of the latest version that has it.

    Ids that occur once, nearly all, pass through. Only repeated ones are taken
    apart, and a hot id is reduced to its fields before it is shuffled.
    """
    repeated = incoming.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    single = incoming.join(repeated, "id", "left_anti").select("id", "raw", *VERSION)
    version = F.struct(*VERSION)
    fields = (
        incoming.join(repeated, "id", "left_semi")
        .select("id", version.alias("version"), F.explode(F.try_variant_get("raw", "$", "map<string,variant>")).alias("field", "value"))
        .groupBy("id", "field")
        .agg(F.max_by("value", "version").alias("value"), F.max("version").alias("version"))
    )
    # as many entries per id as its record has fields
    whole = fields.groupBy("id").agg(
        F.to_variant_object(F.map_from_entries(F.collect_list(F.struct("field", "value")))).alias("raw"),
        F.max("version").alias("version"),
    )
    return single.unionByName(whole.select("id", "raw", *[F.col("version")[v].alias(v) for v in VERSION]))


def _append(versions: DataFrame, path: str) -> None:
    (
        versions.select(*COLUMNS)
        .hint("rebalance")
        .write.option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy("batch_id")
        .parquet(path)
    )


def upsert_documents(spark: SparkSession, path: str, incoming: DataFrame, batch_id: int | None = None) -> DataFrame:
    """Field-level upsert of ``incoming`` (id, raw and the version columns) as one batch.

    Fields are laid over each other in the order (updated_date, file_path, line_no), within a load and between loads.
    A batch that runs again replaces its own partition. The counters per file that are returned compare
    each record before the batch with the record after it, by the batches stored before; so they come out the same
    when it runs again. Without a number the batch comes after all others.
    """
    stored = stored_versions(spark, path)
    if batch_id is None:
        batch_id = stored.agg(F.coalesce(F.max("batch_id") + 1, F.lit(0))).first()[0]
    tags = {"alone": F.lit(False), "batch_id": F.lit(batch_id).cast("long")}
    batch = materialise(incoming.select("id", "raw", *VERSION).withColumns(tags), "document-batch")
    ids = batch.select("id").distinct()
    # read before the batch is written, and only of the ids it touches; other rows are left behind in the scan
    near = possible(stored.where(F.col("batch_id") < batch_id), "id", materialise(id_bitmaps(ids, "id"), "batch-bitmaps"))
    earlier = materialise(near.join(ids, "id", "left_semi").select("id", "raw", *VERSION), "document-earlier")
    _append(batch, path)
    now = merged_by_id(earlier.unionByName(batch.select("id", "raw", *VERSION))).select("id", F.col("raw").alias("now"))
    before = merged_by_id(earlier).select("id", F.col("raw").alias("before"))
    source = batch.groupBy("id").agg(F.max(F.struct(*VERSION)).alias("version")).select("id", F.col("version.file_path").alias("file_path"))
    compared = source.join(now, "id").join(before, "id", "left")
    outcome = (
        F.when(F.col("before").isNull(), "upserted").when(F.to_json("before") == F.to_json("now"), "matched").otherwise("modified")
    )
    return (
        compared.withColumn("outcome", outcome)
        .groupBy("file_path")
        .agg(
            F.count_if(F.col("outcome") == "upserted").alias("upserted"),
            F.count_if(F.col("outcome") != "upserted").alias("matched"),
            F.count_if(F.col("outcome") == "modified").alias("modified"),
        )
    )


def compact_documents(spark: SparkSession, path: str, target: str) -> None:
    """Write the table to ``target`` without what later versions hide: of every version the fields that still count.

    Versions keep their place in the order, so a late delivery to the compacted table gives the same records.
    Records that an earlier compaction left whole, and no batch has touched since, are copied as they are.
    """
    with scratch_run(spark):
        settled, open_ = settled_versions(spark, path)
        few, many = by_versions(open_)
        rows = laid_over(few.select("id", "raw", *VERSION)).where("size(entries) > 0")
        rows = rows.withColumn("alone", F.count(F.lit(1)).over(W.partitionBy("id")) == 1)
        raw = F.when(F.col("whole"), F.col("raw")).otherwise(F.to_variant_object(F.map_from_entries("entries")))
        whole = rows.select("id", raw.alias("raw"), "alone", *VERSION)
        if many is not None:
            whole = whole.unionByName(_fields_by_version(many))
        _append(settled.drop("batch_id").unionByName(whole).withColumn("batch_id", F.lit(BASE).cast("long")), target)


def _fields_by_version(versions: DataFrame) -> DataFrame:
    """``id, raw, alone`` and the version: of every version the fields that no later one has; a field is reduced before it moves."""
    version = F.struct(*VERSION)
    fields = versions.select(
        "id", version.alias("version"), F.explode(F.try_variant_get("raw", "$", "map<string,variant>")).alias("field", "value")
    )
    kept = fields.groupBy("id", "field").agg(F.max_by("value", "version").alias("value"), F.max("version").alias("version"))
    # as many entries as the record has fields
    records = kept.groupBy("id").agg(F.collect_list(F.struct("version", "field", "value")).alias("fields"))
    records = records.withColumn("versions", F.array_distinct(F.transform("fields", lambda f: f["version"])))
    split = records.select("id", "fields", (F.size("versions") == 1).alias("alone"), F.explode("versions").alias("version"))
    its_own = F.filter("fields", lambda f: f["version"].eqNullSafe(F.col("version")))
    entries = F.transform(its_own, lambda f: F.struct(f["field"].alias("field"), f["value"].alias("value")))
    return split.select(
        "id", F.to_variant_object(F.map_from_entries(entries)).alias("raw"), "alone", *[F.col("version")[v].alias(v) for v in VERSION]
    )
