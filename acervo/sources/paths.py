"""File-system questions asked through Hadoop, so they work on any storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.functions.text import base_name


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    matches = fs.globStatus(hadoop_path)
    return matches is not None and len(matches) > 0


def has_files(spark: SparkSession, path: str, suffix: str = "") -> bool:
    """Whether any visible file below ``path`` ends with ``suffix``; stops at the first."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        return False
    files = fs.listFiles(hadoop_path, True)
    while files.hasNext():
        name = files.next().getPath().getName()
        if name.endswith(suffix) and not name.startswith(("_", ".")):
            return True
    return False


def file_listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Listing table of the files below ``path``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            F.col("path").alias("id"),
            base_name(F.col("path")).alias("name"),
            F.col("modificationTime").alias("modified_time"),
            F.col("length").alias("size"),
        )
    )
