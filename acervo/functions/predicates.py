"""Row predicates. All return true or false, never null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Product types that count as bibliographic production.
BIBLIOGRAPHIC_TYPES = (
    "Publicaciones editoriales no especializadas",
    "Notas científica",
    "Informe Final de Investigación",
    "Capítulos de libro de investigación",
    "Libros de investigación",
    "Artículos de investigación",
    "Libros de Formación",
    "Libros",
    "Tesis de doctorado",
    "Capítulos de libro",
    "Documento de trabajo",
    "Tesis de pregrado",
    "Informe técnico final",
    "Artículos",
    "Edicion",
    "Manuales y Guías Especializadas",
    "Boletín divulgativo de resultado de investigación",
    "Libros de Divulgación de investigación y/o Compilación de Divulgación",
    "Tesis de maestria",
    "Generación de contenido impresa",
)
SENTINEL_PRODUCT = "0000000000"
SHORT_TITLE = 30

# Media types of spreadsheets, and the prefix of untouched originals.
SPREADSHEET_TYPES = (
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "application/vnd.ms-excel",
)
ORIGINAL_PREFIX = "original"


def holds(test: Column) -> Column:
    """SQL's unknown counts as false."""
    return F.coalesce(test, F.lit(False))


def has_text(value: Column) -> Column:
    return holds(value != "")


def nonzero(value: Column) -> Column:
    return holds(value != 0)


def not_flagged(flag: Column) -> Column:
    """Only an exact true is dropped; null and missing stay."""
    return ~holds(flag)


def not_blank_or_null_passes(value: Column) -> Column:
    """Rule of sources that only exclude the empty text: null passes."""
    return value.isNull() | holds(value != "")


def present_number(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)


def in_country(authorships: Column, country: str) -> Column:
    """Any authorship with the country, or with an institution in it."""
    return holds(
        F.exists(
            authorships,
            lambda a: holds(F.array_contains(a["countries"], country))
            | holds(F.exists(a["institutions"], lambda i: holds(i["country_code"] == country))),
        )
    )


def identifier_values(fields: Column) -> Column:
    """Texts of the metadata fields ``identifier``/``doi``."""
    matching = F.filter(
        fields, lambda f: holds((f["element"] == "identifier") & (f["qualifier"] == "doi"))
    )
    return F.filter(F.transform(matching, lambda f: f["text"]), lambda t: t.isNotNull())


def bibliographic(product_type: Column) -> Column:
    return holds(product_type.isin(*BIBLIOGRAPHIC_TYPES))


def searchable(title: Column, author: Column) -> Column:
    """A product without author needs a title of at least 30 characters."""
    return has_text(title) & (author.isNotNull() | holds(F.char_length(title) >= SHORT_TITLE))


def usable_workbook(name: Column, media_type: Column, trashed: Column) -> Column:
    return (
        holds(media_type.isin(*SPREADSHEET_TYPES))
        & not_flagged(trashed)
        & ~holds(F.lower(name).startswith(ORIGINAL_PREFIX))
    )


def any_value(*cells: Column) -> Column:
    return F.coalesce(*[c.cast("string") for c in cells]).isNotNull()


def key_between(key: Column, low: str | int | None, high: str | int | None) -> Column:
    """Half-open ``[low, high)``; null or ``""`` leaves that end open."""
    test = key.isNotNull()
    if low not in (None, ""):
        test = test & (key >= F.lit(low))
    if high not in (None, ""):
        test = test & (key < F.lit(high))
    return test


def long_or_zero(value: Column) -> Column:
    """Number part as a long; anything that is no number gives 0."""
    number = value.try_cast("double")
    return F.coalesce(F.when(~F.isnan(number), number.try_cast("long")), F.lit(0).cast("long"))
