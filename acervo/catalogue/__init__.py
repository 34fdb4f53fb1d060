"""Registered queries: every operator on the given tables, with an equal SQL text."""

from __future__ import annotations

from acervo.catalogue import cuts, fields, files, maintenance, pipelines, reports, roundtrips
from acervo.catalogue.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "cuts", "fields", "files", "maintenance", "pipelines", "reports", "roundtrips"]
