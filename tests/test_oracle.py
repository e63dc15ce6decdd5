"""Every registered query against its SQL in DuckDB, over the whole tables."""

from __future__ import annotations

import pytest

from cohortlane_checks.compare import difference, duck
from cohortlane_checks.oracle import ORACLE
from cohortlane_checks.queries import registered

QUERIES = registered()


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, folder, name):
    assert difference(QUERIES[name](spark, folder), con, ORACLE[name]) is None
