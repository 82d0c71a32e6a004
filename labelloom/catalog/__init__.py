"""Registered queries with the SQL that states the same result."""

from __future__ import annotations

from labelloom.catalog import corpus, features, models, sampling, survey, tags

AREAS = (corpus, tags, sampling, features, models, survey)
QUERIES = {name: run for area in AREAS for name, run in area.area.queries.items()}
SQL = {name: text for area in AREAS for name, text in area.area.sql.items()}
