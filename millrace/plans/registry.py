"""All registered queries and their comparison SQL."""

from __future__ import annotations

from millrace.plans import edits, text, trips

QUERIES = {**text.QUERIES, **trips.QUERIES, **edits.QUERIES}
ORACLE = {**text.ORACLE, **trips.ORACLE, **edits.ORACLE}
