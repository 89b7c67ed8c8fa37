"""What the tests share: the folder of small tables, rows of a result, its physical plan."""

from __future__ import annotations

import os

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows(frame, *columns):
    """Rows as a sorted list of tuples."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(row) for row in picked.collect()), key=repr)


def plan(frame) -> str:
    """The physical plan."""
    return frame._jdf.queryExecution().executedPlan().toString()
