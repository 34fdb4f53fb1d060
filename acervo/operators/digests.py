"""Diff of two large tables that are mostly equal, by a tree of digests over ranges of key hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.operators import merge
from acervo.session import materialise

#: Branches of a node of the tree; it has two levels, so a million leaves.
WIDTH = 1 << 10
_TOP, _SUB, _SUMS = "__top", "__sub", ["__d0", "__d1", "__d2", "__d3", "__rows"]


def _digest(parts: Sequence[Column], seed: int) -> list[Column]:
    """A row's 64 bits as two numbers of 32, whose sums over a billion rows still fit a long."""
    bits = F.xxhash64(F.lit(seed), *parts)
    return [F.shiftright(bits, 32), bits.bitwiseAND(F.lit(0xFFFFFFFF))]


def _hashed(rows: DataFrame, keys: Sequence[str], fields: Sequence[str], width: int) -> DataFrame:
    """``rows`` with the node of each and its digest; a row with a null key, which equals no other, has no node.

    A hash passes over nulls, so which values are null is part of what is hashed; nested values count by their JSON text.
    """
    kinds = dict(rows.dtypes)

    def value(name: str) -> Column:
        if name not in kinds:
            return F.lit(None).cast("string")
        nested = kinds[name].startswith(("array", "struct"))
        return F.to_json(f"`{name}`", {"ignoreNullFields": "false"}) if nested else F.col(f"`{name}`")

    values = [value(name) for name in [*keys, *fields]]
    parts = [F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values]), *values]
    whole = [F.col(f"`{k}`").isNotNull() for k in keys]
    usable = whole[0]
    for test in whole[1:]:
        usable = usable & test
    place = F.xxhash64(*values[: len(keys)])
    columns = {
        _TOP: F.when(usable, F.pmod(place, F.lit(width))),
        _SUB: F.pmod(F.shiftright(place, 32), F.lit(width)),
        **dict(zip(_SUMS, [*_digest(parts, 0), *_digest(parts, 1)], strict=False)),
    }
    return rows.withColumns(columns)


def _unequal(old: DataFrame, new: DataFrame, node: Sequence[str]) -> DataFrame:
    """Nodes whose rows are not the same on both sides: the digests of one side less those of the other do not sum to zero.

    Sums are built in the scan; what is exchanged is at most a row for each node and task.
    """
    sides = [
        df.where(F.col(_TOP).isNotNull()).select(*node, *[(F.col(s) * sign if s != "__rows" else F.lit(sign)).cast("long").alias(s) for s in _SUMS])
        for df, sign in ((old, 1), (new, -1))
    ]
    sums = sides[0].unionByName(sides[1]).groupBy(*node).agg(*[F.sum(s).alias(s) for s in _SUMS])
    return sums.where(" or ".join(f"{s} <> 0" for s in _SUMS)).select(*node)


def open_rows(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], ignore: Sequence[str] = (), width: int = WIDTH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(stored rows, incoming rows) of leaves that differ, and the incoming rows of all others, which are unchanged.

    Only nodes that differ are looked at one level deeper. At a leaf two sides are taken for equal if they have
    as many rows and the same sums of 128 bits a row.
    """
    fields = [c for c in dict.fromkeys([*stored.columns, *incoming.columns]) if c not in (*keys, *ignore)]
    old, new = (_hashed(df, keys, fields, width) for df in (stored, incoming))
    tops = materialise(_unequal(old, new, [_TOP]), "unequal-nodes")
    below = [df.join(tops, _TOP, "left_semi") for df in (old, new)]
    leaves = materialise(_unequal(*below, [_TOP, _SUB]), "unequal-leaves")

    def opened(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        rows = df.where(F.col(_TOP).isNull()).unionByName(df.join(leaves, [_TOP, _SUB], "left_semi"))
        return rows.select(*[f"`{c}`" for c in columns])

    same = new.where(F.col(_TOP).isNotNull()).join(leaves, [_TOP, _SUB], "left_anti").select(*[f"`{c}`" for c in incoming.columns])
    return opened(old, stored.columns), opened(new, incoming.columns), same


def diff(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], ignore: Sequence[str] = (), width: int = WIDTH) -> DataFrame:
    """``(keys, action)`` as ``merge.diff`` gives it, exchanging only rows near a difference.

    Both tables are scanned for their digests; rows are paired by an exchange only in leaves that differ, and
    those of all other leaves are unchanged as they are. Two tables whose columns have other types hash
    differently, so every leaf is opened: slower, with the same result.
    """
    old, new, same = open_rows(stored, incoming, keys, ignore, width)
    return merge.diff(old, new, keys, ignore).unionByName(same.select(*keys, F.lit("unchanged").alias("action")))
