"""One shape for all sources: what it reads, its key, and how it is loaded."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

MODES = ("upsert", "replace", "truncate", "append")


@dataclass(frozen=True)
class Source:
    """``read(spark)`` gives (good rows, rejects); nothing runs until a sink writes.

    ``order`` says which of several rows of one key counts: the first by these expressions, each with `` desc`` behind it if need be. Without it a repeated key is an error of the source.
    """

    name: str
    key: tuple[str, ...]
    mode: str
    read: Callable[[SparkSession], tuple[DataFrame, DataFrame]]
    order: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, got {self.mode!r}")
