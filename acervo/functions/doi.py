"""DOI extraction and normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The DOI shape in the captured pages (at least three digits after
# "10."), and the stored prefix.
HTML_DOI_PATTERN = r"""(?i)10\.\d{3,}/[^\s"'<]+"""
DOI_PREFIX = "https://doi.org/"

# A DOI ends before trailing sentence punctuation; a closing parenthesis belongs
# to it only when it also opens one.
_DOI = (
    r"""10\.\d{3,}/(?=\S*\()\S*[^\s.,;:"'>\]}]"""
    r"""|10\.\d{3,}/[^\s(]*[^\s(.,;:"'>\]})]"""
)


def normalise_doi(value: Column) -> Column:
    """Stored form ``https://doi.org/10.x/y`` in lower case; null when there is no DOI.

    Scheme, host and ``doi:`` prefixes fall away because the first DOI in the text is taken.
    """
    first = F.get(F.regexp_extract_all(F.lower(value), F.lit(_DOI), F.lit(0)), F.lit(0))
    return F.concat(F.lit(DOI_PREFIX), first)


def doi_candidates(html: Column) -> Column:
    """Every DOI-shaped piece of an HTML text, in order, with repeats."""
    return F.regexp_extract_all(html, F.lit(HTML_DOI_PATTERN), F.lit(0))


def page_dois(html: Column) -> Column:
    """Distinct valid DOIs of an HTML text."""
    return F.array_distinct(
        F.filter(F.transform(doi_candidates(html), normalise_doi), lambda d: d.isNotNull())
    )
