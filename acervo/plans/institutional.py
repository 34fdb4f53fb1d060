"""Institutional matrices: latest workbook per institution folder, replaced as a group."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.functions.names import folder_institution, folder_label, iso_stamp, matrix_date, matrix_date_text
from acervo.functions.predicates import usable_workbook
from acervo.operators.dedup import latest_per_group
from acervo.operators.lineage import with_lineage
from acervo.operators.merge import replace_groups, replace_rows
from acervo.operators.stats import outcome_counts
from acervo.session import materialise
from acervo.sinks.catalog import replace_partitions, replace_rows_table

PROBE = ["institution_id", "drive_file_id", "drive_modified_time"]


def latest_files(folders: DataFrame, listing: DataFrame) -> DataFrame:
    """One row per folder (id, name) with its institution and latest usable workbook.

    listing: folder_id, id, name, mime_type, trashed, modified_time, size, position.
    ``outcome`` is skipped for a malformed name, empty without a workbook, else null.
    """
    usable = listing.where(usable_workbook(F.col("name"), F.col("mime_type"), F.col("trashed")))
    latest = latest_per_group(usable, ["folder_id"], "modified_time", [F.col("position")])
    files = latest.select(
        F.col("folder_id").alias("drive_folder_id"),
        F.col("id").alias("drive_file_id"),
        F.coalesce("name", F.lit("")).alias("drive_file_name"),
        F.coalesce("modified_time", F.lit("")).alias("drive_modified_time"),
        F.col("size").alias("drive_file_size"),
    )
    named = folders.select(
        F.col("id").alias("drive_folder_id"),
        F.col("name").alias("folder_name"),
        folder_institution(F.col("name")).alias("institution_id"),
        folder_label(F.col("name")).alias("institution_name"),
    )
    malformed = F.col("institution_id").isNull() | (F.col("institution_id") == "")
    return named.join(files, "drive_folder_id", "left").withColumn(
        "outcome", F.when(malformed, "skipped").when(F.col("drive_file_id").isNull(), "empty")
    )


def plan_run(latest: DataFrame, stored: DataFrame, readable: DataFrame | None = None, force: bool = False) -> DataFrame:
    """Outcome of every folder: processed, skipped, empty or errors.

    ``stored`` holds what is loaded already; ``readable`` the ids of the files that
    could be read, when that is known.
    """
    loaded = stored.select(*PROBE).distinct().withColumn("loaded", F.lit(True))
    marked = latest.join(loaded, PROBE, "left")
    outcome = F.coalesce("outcome", F.when(F.col("loaded") & ~F.lit(force), "skipped"))
    if readable is not None:
        ok = readable.select("drive_file_id").distinct().withColumn("ok", F.lit(True))
        marked = marked.join(ok, "drive_file_id", "left")
        outcome = F.coalesce(outcome, F.when(F.col("ok").isNull(), "errors"))
    return marked.withColumn("outcome", F.coalesce(outcome, F.lit("processed"))).drop("loaded", "ok")


def matrix_rows(planned: DataFrame, rows: DataFrame, run_time: datetime, dated: bool = False) -> DataFrame:
    """Rows of the processed files with lineage. rows: drive_file_id, row_number, columns.

    ``dated`` adds the date that the file name carries.
    """
    files = planned.where("outcome = 'processed'").drop("outcome", "folder_name")
    if dated:
        name = F.col("drive_file_name")
        files = files.withColumns(
            {"ciarp_file_date": iso_stamp(matrix_date(name)), "ciarp_file_date_raw": matrix_date_text(name)}
        )
    stamped = with_lineage(
        rows.withColumn("file_id", F.col("drive_file_id")), files, "drive_file_id", F.lit(run_time.isoformat())
    )
    return stamped.drop("file_id")


def next_state(stored: DataFrame, planned: DataFrame, rows: DataFrame, keep_only_latest: bool = True) -> DataFrame:
    """Table after the run. A processed institution without rows ends empty."""
    if not keep_only_latest:
        return replace_rows(stored, rows, ["_id"])
    return replace_groups(stored, rows, ["institution_id"], planned.where("outcome = 'processed'"))


def run_matrices(
    spark: SparkSession,
    folders: DataFrame,
    listing: DataFrame,
    rows: DataFrame,
    table: str,
    run_time: datetime,
    keep_only_latest: bool = True,
    force: bool = False,
    dated: bool = False,
) -> DataFrame:
    """One load: listing, plan, rows with lineage, the institutions' partitions replaced or rows appended by id; the outcome counts.

    ``rows``: drive_file_id, row_number and columns of all files that could be read. A file that is listed but has no row
    counts as read: its institution ends empty.
    """
    latest = materialise(latest_files(folders, listing), "latest-files")
    stored = spark.table(table) if spark.catalog.tableExists(table) else latest.limit(0)
    planned = materialise(plan_run(latest, stored, None, force), "planned-files")
    loaded = matrix_rows(planned, rows, run_time, dated)
    if keep_only_latest:
        replace_partitions(loaded, table, "institution_id", planned.where("outcome = 'processed'").select("institution_id"))
    else:
        replace_rows_table(loaded, table, ["_id"])
    return outcome_counts(planned, "outcome")
