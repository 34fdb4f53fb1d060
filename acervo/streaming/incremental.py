"""Incremental snapshot load: each file once, upserted per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.session import discard, materialise, scratch_run
from acervo.sinks.documents import upsert_documents
from acervo.sources.paths import has_files
from acervo.sources.snapshot import entity_flag, entity_path, parse_lines, split_parsed

#: Files of one batch.
FILES_PER_BATCH = 1000


def load_snapshot(
    spark: SparkSession,
    base: str,
    entity: str,
    target: str,
    checkpoint: str,
    rejects: str,
    metrics: str,
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Load the files that are not loaded yet, then stop.

    The stream's checkpoint keeps the set of loaded files and advances only
    after a batch is written. A batch that runs twice gives the same records, rejects and metrics: all
    three are partitions named after the batch, and its counters compare with the batches before it.

    ``files_per_batch`` bounds the unit of a retry; a batch only adds to the target, so more batches cost no rewriting.
    """
    path = entity_path(base, entity)
    if not has_files(spark, path, ".gz"):
        return

    def load(batch: DataFrame, batch_id: int) -> None:
        with scratch_run(spark):
            write(batch, batch_id)

    def write(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("line_no", F.monotonically_increasing_id())
        # parsed once; gzip files are read by one task each, the parsed rows by many
        parsed = materialise(parse_lines(numbered, "id", entity_flag(entity)), "parsed-lines")
        good, bad = split_parsed(parsed)
        by_batch = {"partitionOverwriteMode": "dynamic"}
        tag = F.lit(batch_id).alias("batch_id")
        written = upsert_documents(spark, target, good, batch_id)
        bad.select("*", tag).write.options(**by_batch).mode("overwrite").partitionBy("batch_id").parquet(rejects)
        counts = parsed.groupBy("file_path").agg(
            F.count_if(F.col("reason").isNull() & ~F.col("flagged")).alias("records"),
            F.count_if(F.col("flagged")).alias("skipped"),
            F.count_if(F.col("reason").isNotNull()).alias("errors"),
        )
        (
            counts.join(written, "file_path", "left")
            .na.fill(0)
            .select(F.lit(entity).alias("entity"), "*", tag)
            .write.options(**by_batch)
            .mode("overwrite")
            .partitionBy("batch_id")
            .parquet(metrics)
        )

    reader = spark.readStream.format("text").schema("value string, updated_date date").option("pathGlobFilter", "*.gz")
    reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = (
        reader.load(path)
        .select("value", "updated_date", F.col("_metadata.file_path").alias("file_path"))
    )
    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def reset_snapshot(spark: SparkSession, target: str, checkpoint: str, rejects: str, metrics: str) -> None:
    """Forget a load: its records, the set of loaded files, rejects and metrics. The next load reads every file again.

    The checkpoint goes first: if the reset breaks off, files are loaded once more and not skipped.
    """
    for path in (checkpoint, target, rejects, metrics):
        discard(spark, path)


def load_totals(metrics: DataFrame) -> DataFrame:
    """Counters per entity and in total (entity null)."""
    counters = ["records", "skipped", "errors", "upserted", "matched", "modified"]
    return metrics.rollup("entity").agg(
        F.count("*").alias("files_processed"), *[F.sum(c).alias(c) for c in counters]
    )
