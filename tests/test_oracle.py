"""Every registered query against its SQL, or at least run to the end."""

from __future__ import annotations

import compare
import pytest
from helpers import SF_DIR

import __spark_entry__ as entry_points
from millrace.plans.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    if name in ORACLE:
        assert compare.differences(result, duck, ORACLE[name]) == ""
    else:
        assert result.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_only_ids_without_meaning_lack_sql():
    assert set(QUERIES) - set(ORACLE) == {"trips_with_id"}


def test_entry_points_offer_all_of_them():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["word", "n"]
    assert result.count() > 0
