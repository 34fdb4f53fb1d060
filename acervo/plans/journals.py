"""Open-access journal and article records: derived fields and upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.functions.ids import article_id, canonical_sha1, journal_id
from acervo.functions.nested import as_array, at, first_where, is_object, kept_values, truthy, truthy_text
from acervo.functions.text import strip_text
from acervo.operators.dedup import first_per_key


def record_doi(raw: Column) -> Column:
    """Trimmed text of the first identifier of type doi that has one."""
    identifiers = F.filter(as_array(at(raw, "$.bibjson.identifier", "variant")), is_object)
    of_doi = F.filter(identifiers, lambda i: F.lower(at(i, "$.type")) == "doi")
    values = kept_values(of_doi, lambda i: truthy_text(i, "$.id", "$.value", "$.identifier"))
    return strip_text(first_where(values, lambda v: v.isNotNull()))


def _issn_texts(raw: Column) -> Column:
    value = at(raw, "$.bibjson.issn", "variant")
    return F.when(truthy(value), F.transform(as_array(value), lambda v: at(v, "$")))


def derive_fields(records: DataFrame, record_type: str) -> DataFrame:
    """Add source_id and the searchable fields to ``raw`` records.

    Fallback chains skip empty values: an empty text, 0 or an empty list counts as missing.
    """
    raw = F.col("raw")
    subjects = [at(raw, p, "variant") for p in ("$.bibjson.subject", "$.bibjson.subjects")]
    fields = records.withColumns(
        {
            "doaj_id": truthy_text(raw, "$.id", "$._id"),
            "doi": record_doi(raw),
            "pissn": at(raw, "$.bibjson.pissn"),
            "eissn": at(raw, "$.bibjson.eissn"),
            "issn": _issn_texts(raw),
            "publisher": truthy_text(raw, "$.bibjson.publisher", "$.publisher"),
            "year": truthy_text(raw, "$.bibjson.year", "$.year"),
            "subjects": F.coalesce(
                *[F.when(truthy(s), as_array(s)) for s in subjects], F.array().cast("array<variant>")
            ),
        }
    )
    digest = canonical_sha1(F.to_json(raw))
    key = (
        article_id(F.col("doi"), F.col("doaj_id"), digest)
        if record_type == "article"
        else journal_id(F.col("doaj_id"), F.col("pissn"), F.col("eissn"), F.col("issn"), digest)
    )
    return fields.withColumns({"source_id": key, "record_type": F.lit(record_type)})


def upsert_rows(derived: DataFrame, run_time: Column) -> DataFrame:
    """One row per source_id, the last in (file, position) order, with both time stamps.

    ``created_at`` is an insert-only field of the upsert that follows.
    """
    latest = first_per_key(derived, ["source_id"], [F.desc("file_path"), F.desc("position")])
    return latest.drop("file_path", "position").withColumns({"updated_at": run_time, "created_at": run_time})
