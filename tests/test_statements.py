"""Statements on small tables of their own."""

import datetime as dt

from stemforge.plans import registry


def test_sibling_control(spark, tmp_path):
    stems = [
        ("p_1", "攺碓攺", 1), ("p_2", "改正改善", 1), ("q_1", "碓", 1), ("q_2", "塊", 1),
        ("r_1", "堍", 1), ("r_1", "境", 2), ("s_1", "攄據", 1), (None, "宄", 1), (None, "先宄", 1),
    ]
    rows = [(i, q, s, dt.datetime(2024, 1, d)) for i, (q, s, d) in enumerate(stems)]
    spark.createDataFrame(rows, "row_id bigint, qid string, stem string, loaded_at timestamp_ntz").write.parquet(f"{tmp_path}/bank.parquet")
    got = sorted((r["row_id"], r["odd"], r["times"], r["siblings"], r["accepted"]) for r in registry.QUERIES["drv11_sibling_control"](spark, str(tmp_path)).collect())
    assert got == [(0, "攺", 2, 2, True), (0, "碓", 1, 0, False), (2, "碓", 1, 0, False), (4, "堍", 1, 0, False), (6, "攄", 1, 1, True), (7, "宄", 1, 0, False), (8, "宄", 1, 1, True)]
