"""Journal ranking files: semicolon CSV, one per year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.functions.predicates import long_or_zero
from acervo.operators.dedup import first_per_key

KEY = "Sourceid"


def underscored(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace(".", "_") for c in df.columns])


def read_ranking(spark: SparkSession, path: str, year: int) -> tuple[DataFrame, DataFrame]:
    """(one row per journal with its ``year``, rows without a usable key).

    The first row of a key in file order stays. Decimal commas remain text.
    """
    rows = (
        spark.read.csv(path, sep=";", header=True, inferSchema=True, multiLine=True, escape='"')
        .withColumn("__at", F.monotonically_increasing_id())
    )
    rows = underscored(rows).withColumn(KEY, long_or_zero(F.col(KEY))).withColumn("year", F.lit(int(year)))
    good = first_per_key(rows.where(F.col(KEY) != 0), [KEY], [F.col("__at")]).drop("__at")
    return good, rows.where(F.col(KEY) == 0).drop("__at")
