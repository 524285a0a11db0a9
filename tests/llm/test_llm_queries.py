"""The training-text queries run on the smallest tables and agree with SQL or brute force."""

import os
import re
from itertools import combinations

import pytest

from stemforge.functions.lookalike import look_key
from stemforge.llm import queries
from stemforge.session import table
from tests.test_queries import DATA, compare

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_rows(spark, name):
    compare(spark, queries.QUERIES, queries.SQL, name)


def test_look_alike_explanations(spark):
    rows = [(r["expl_id"], r["t"]) for r in table(spark, DATA, "explanations").where("t is not null").collect()]
    want = {(min(a, b), max(a, b)) for (a, s), (b, t) in combinations(rows, 2) if s != t and look_key(s) == look_key(t)}
    got = {(r["id_a"], r["id_b"]) for r in queries.QUERIES["p1_found"](spark, DATA).where("src_table = 'explanations'").collect()}
    assert got == want


def test_repaired_stems_follow_the_proofs(spark):
    text = {r["row_id"]: r["text"] for r in queries.QUERIES["p2_text"](spark, DATA).collect()}
    proofs = [(r["row_id"], r["stem"]) for r in table(spark, DATA, "proof_stems").collect()]
    near = [i for i, p in proofs if text[i] is not None and abs(len(re.sub(r"\s", "", text[i])) - len(re.sub(r"\s", "", p))) <= 2]
    assert len(near) >= 0.8 * len(proofs)


@pytest.mark.parametrize("name", ["p6_fill", "p7_shares", "p8_composition", "p5_links"])
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() > 0
