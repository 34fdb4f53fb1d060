"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_RUNS: ContextVar[list[str] | None] = ContextVar("scratch", default=None)

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "acervo", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def on_one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for intermediate tables, from ``spark.checkpoint.dir``.

    Where it is not set, a session on one machine (master ``local[...]``) uses a temporary folder; on a cluster
    executors would each write to their own, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not on_one_machine(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="acervo-checkpoint-")
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/acervo/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop; one that is not there is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialise`` writes inside go when the run ends well; a failed run leaves them to be looked at.

    For runs that write their result. A plan that is returned unread still needs its tables.
    """
    outer, mine = _RUNS.get(), []
    _RUNS.set(mine)
    try:
        yield
        for path in mine:
            discard(spark, path)
    finally:
        _RUNS.set(outer)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go as soon as it has ended, not when the driver next collects its garbage.

    For runs of several queries over large tables, whose files would lie beside each other till the end.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, and pins values that a recomputation could change
    (partition ids, positions after a sampled range partitioning). A lost
    executor only costs re-reading a file.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if (run := _RUNS.get()) is not None:
        run.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
