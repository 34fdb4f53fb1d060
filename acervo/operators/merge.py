"""Idempotent table maintenance as plans: each function returns the new state.

Source rows must be unique by key; ``first_per_key`` makes them so.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OLD, _NEW = "__old", "__new"


def _paired(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join with each side's other columns in one struct, null when absent."""

    def packed(df: DataFrame, name: str) -> DataFrame:
        rest = [c for c in df.columns if c not in keys]
        return df.select(*keys, F.struct(F.lit(True).alias("__there"), *rest).alias(name))

    return packed(target, _OLD).join(packed(source, _NEW), list(keys), "full_outer")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    present: Mapping[str, Column] | None = None,
    insert_only: Sequence[str] = (),
) -> DataFrame:
    """Field-level upsert.

    ``present[field]``, a test over the source row's columns, says whether the row
    has the field; a field that is present and null overwrites, an absent one keeps the
    stored value. Columns the source lacks are absent. ``insert_only`` fields
    are taken from the source for new keys only.
    """
    present = dict(present or {})
    flags = {f: f"__has_{f}" for f in present}
    marked = source.withColumns({flags[f]: F.coalesce(test, F.lit(False)) for f, test in present.items()})
    joined = _paired(target, marked, keys)
    old, new = F.col(_OLD), F.col(_NEW)
    fields = [c for c in dict.fromkeys([*target.columns, *source.columns]) if c not in keys]
    merged = []
    for f in fields:
        if f not in source.columns:
            value = old[f]
        else:
            taken = new["__there"].isNotNull()
            if f in flags:
                taken = taken & new[flags[f]]
            if f in insert_only:
                taken = taken & old["__there"].isNull()
            value = F.when(taken, new[f])
            if f in target.columns:
                value = value.otherwise(old[f])
        merged.append(value.alias(f))
    return joined.select(*keys, *merged)


def replace_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole-row replace by key; rows of other keys stay."""
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def keep_existing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert only the rows whose key is not stored yet."""
    fresh = source.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def replace_groups(target: DataFrame, source: DataFrame, group: Sequence[str], groups: DataFrame) -> DataFrame:
    """Replace every row of the named groups; a group without source rows ends empty."""
    named = groups.select(*group).distinct()
    kept = target.join(named, list(group), "left_anti")
    incoming = source.join(named, list(group), "left_semi")
    return kept.unionByName(incoming, allowMissingColumns=True)


def diff(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """``(keys, action)`` with action insert, update, unchanged or absent.

    Rows are equal when all columns of both sides are equal, null to null and
    NaN to NaN; a column only one side has counts as null on the other.
    """
    joined = _paired(stored, incoming, keys)
    old, new = F.col(_OLD), F.col(_NEW)
    fields = [c for c in dict.fromkeys([*stored.columns, *incoming.columns]) if c not in (*keys, *ignore)]
    equal = F.lit(True)
    for f in fields:
        a = old[f] if f in stored.columns else F.lit(None)
        b = new[f] if f in incoming.columns else F.lit(None)
        equal = equal & a.eqNullSafe(b)
    action = (
        F.when(old["__there"].isNull(), "insert")
        .when(new["__there"].isNull(), "absent")
        .when(equal, "unchanged")
        .otherwise("update")
    )
    return joined.select(*keys, action.alias("action"))


def diff_summary(actions: DataFrame) -> DataFrame:
    return actions.groupBy("action").agg(F.count("*").alias("n"))


def apply_diff(stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State after a diff load: incoming rows as they are, rows only stored kept."""
    return replace_rows(stored, incoming, keys)
