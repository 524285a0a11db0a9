"""Snapshots and orphans on empty tables, and on tables with rows of nulls, repeated rows and clashing extra columns, where the other rows' results stay."""

import os

import pytest

from stemforge.plans import registry
from tests import edges
from tests.test_queries import DATA

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
NAMES = ["p3_found", "p3_change_counts", "p4_found", "p4_report", "p4_ledger"]


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return edges.save(spark, str(tmp_path_factory.mktemp("empty")), "empty")


@pytest.fixture(scope="module")
def nulls(spark, tmp_path_factory):
    return edges.save(spark, str(tmp_path_factory.mktemp("nulls")), "nulls")


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, empty, name):
    assert registry.QUERIES[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", NAMES)
def test_nulls_repeats_and_clashing_columns(spark, nulls, name):
    got, want = (sorted(map(tuple, registry.QUERIES[name](spark, d).collect()), key=repr) for d in (nulls, DATA))
    assert got == want
