"""Row validation, unique-key contracts and count checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.operators.dedup import duplicate_keys


def failed_rules(rules: Mapping[str, Column]) -> Column:
    """Names of the rules a row breaks. A rule that gives null is broken."""
    return F.array_compact(
        F.array(*[F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items()])
    )


def validate(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects with their ``reasons``)."""
    checked = df.withColumn("reasons", failed_rules(rules))
    return checked.where(F.size("reasons") == 0).drop("reasons"), checked.where(F.size("reasons") > 0)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail when a key repeats; the message shows a few of the keys."""
    found = duplicate_keys(df, keys).take(5)
    if found:
        raise ValueError(f"keys {list(keys)} are not unique, for example {[tuple(r) for r in found]}")


def count_verdict(actual: Column, expected: Column) -> Column:
    return (
        F.when(actual > expected, "clean").when(actual == expected, "match").otherwise("fewer")
    )
