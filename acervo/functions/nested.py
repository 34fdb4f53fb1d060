"""Functions over nested values: typed arrays and structs, and schemaless VARIANT."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from acervo.functions.text import split_list, strip_text

# Where homologated journals keep their ISSNs, in order of trust.
ISSN_KEYS = ("issns", "issn", "issnPrint", "issnElectronico", "issn_electronico", "issn_print")
ISSN_SUBKEYS = ("value", "issn", "codigo", "id")


def first_nonblank(*values: Column) -> Column:
    """First text that is neither null nor empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def or_default(value: Column, default: str = "") -> Column:
    return F.coalesce(value, F.lit(default))


def kept_values(array: Column, value: Callable[[Column], Column]) -> Column:
    """``value`` of each element, elements without one left out, order kept."""
    return F.filter(F.transform(array, value), lambda x: x.isNotNull())


def first_where(array: Column, test: Callable[[Column], Column]) -> Column:
    return F.get(F.filter(array, test), F.lit(0))


# -- VARIANT ---------------------------------------------------------------


def at(doc: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(doc, path, kind)


def kind_of(value: Column) -> Column:
    return F.schema_of_variant(value)


def is_object(value: Column) -> Column:
    return F.coalesce(kind_of(value).startswith("OBJECT"), F.lit(False))


def is_array(value: Column) -> Column:
    return F.coalesce(kind_of(value).startswith("ARRAY"), F.lit(False))


def is_text(value: Column) -> Column:
    return F.coalesce(kind_of(value) == "STRING", F.lit(False))


def truthy(value: Column) -> Column:
    """False for a missing or null value, ``""``, zero, false, ``[]`` and ``{}``."""
    text = F.try_variant_get(value, "$", "string")
    return F.coalesce(
        F.when(kind_of(value) == "STRING", text != "").otherwise(
            ~text.rlike(r"^(-?0(\.0*)?([eE][+-]?\d+)?|false|\[\]|\{\})$")
        ),
        F.lit(False),
    )


def truthy_text(doc: Column, *paths: str) -> Column:
    """Text of the first path with a truthy value."""
    return F.coalesce(*[F.when(truthy(at(doc, p, "variant")), at(doc, p)) for p in paths])


def as_array(value: Column) -> Column:
    """Array of VARIANT: an array as it is, any other present value as one element."""
    return F.when(is_array(value), F.try_variant_get(value, "$", "array<variant>")).when(
        value.isNotNull() & (kind_of(value) != "VOID"), F.array(value)
    )


def issn_list(doc: Column, keys: Sequence[str] = ISSN_KEYS) -> Column:
    """Distinct ISSNs of a record, from text, a list of texts or objects, or a scalar."""
    found = F.coalesce(*[F.when(truthy(at(doc, f"$.{k}", "variant")), at(doc, f"$.{k}", "variant")) for k in keys])

    def subkey(entry: Column, key: str) -> Column:
        value = at(entry, f"$.{key}", "variant")
        return F.when(is_text(value), F.nullif(strip_text(at(value, "$")), F.lit("")))

    def element(entry: Column) -> Column:
        return F.when(is_text(entry), F.nullif(strip_text(at(entry, "$")), F.lit(""))).when(
            is_object(entry), F.coalesce(*[subkey(entry, k) for k in ISSN_SUBKEYS])
        )

    values = (
        F.when(is_array(found), kept_values(at(found, "$", "array<variant>"), element))
        .when(is_text(found), split_list(at(found, "$")))
        .when(found.isNotNull(), F.filter(F.array(strip_text(at(found, "$"))), lambda x: x != ""))
    )
    return F.coalesce(F.array_distinct(values), F.array().cast("array<string>"))


def merge_objects(stored: Column, incoming: Column) -> Column:
    """Object with the incoming keys laid over the stored ones.

    A key that is present with null overwrites; an absent key keeps the stored value.
    """
    old = F.try_variant_get(stored, "$", "map<string,variant>")
    new = F.try_variant_get(incoming, "$", "map<string,variant>")
    keys = F.map_keys(new)
    kept = F.map_filter(old, lambda k, _: ~F.array_contains(keys, k))
    return F.when(stored.isNull(), incoming).when(incoming.isNull(), stored).otherwise(
        F.to_variant_object(F.map_concat(kept, new))
    )
