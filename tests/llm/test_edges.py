"""The queries for training text on empty tables, and on tables with rows of nulls, repeated rows and clashing extra columns, where the other rows' results stay."""

import os

import pytest

from stemforge.llm import queries
from tests import edges
from tests.test_queries import DATA

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return edges.save(spark, str(tmp_path_factory.mktemp("empty")), "empty")


@pytest.fixture(scope="module")
def nulls(spark, tmp_path_factory):
    return edges.save(spark, str(tmp_path_factory.mktemp("nulls")), "nulls")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, empty, name):
    assert queries.QUERIES[name](spark, empty).collect() == []


#: Null rows come out as rows of these; of the others nothing.
OWN = {"p1_forms": lambda r: r["id"] == -1, "p2_text": lambda r: r["row_id"] == -1}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_nulls_repeats_and_clashing_columns(spark, nulls, name):
    mine = OWN.get(name, lambda r: False)
    got, want = (sorted((tuple(r) for r in queries.QUERIES[name](spark, d).collect() if not mine(r)), key=repr) for d in (nulls, DATA))
    assert got == want
