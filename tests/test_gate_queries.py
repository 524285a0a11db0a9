"""Gate queries on small tables of their own."""

import datetime as dt
import random
import re

import pytest

from stemforge.operators.citations import Names
from stemforge.plans import registry

DAY = dt.datetime(2024, 1, 1)


@pytest.fixture
def save(spark, tmp_path):
    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


def test_letter_faults(spark, save):
    four, five = dict.fromkeys("ABCD", "x"), dict.fromkeys("ABCDE", "x")
    bank = [("p_1", "單選", four, "A"), ("p_2", "多選", five, "AC"), ("p_3", "非選", None, "／"), ("p_4", "單選", None, "A"), ("p_5", "單選", four, None)]
    save("bank", [(i, q, t, o, a, DAY) for i, (q, t, o, a) in enumerate(bank)], "row_id bigint, qid string, type string, options map<string,string>, answer string, loaded_at timestamp_ntz")
    texts = [
        ("p_1", "正解：(A)。\n\n(B) x。(C) x。(D) x。\n\n本題考點：x。"),
        (" P_1", "正解：(A)。\r\n\r\n(В) x。（Ｃ） x。(D) x。\r\n\r\n本題考點：(A)。"),
        ("p_1", "正解：(A)。(D)\n\n(B) x。(C) x。\n\n本題考點：x。"),
        ("p_1", "正解：(A)。\n\nA：x\n\nB：x\n\nC：x\n\nD：x"),
        ("p_2", "正解：(AC)。\n\n(A) x。(B) x。(D) x。(E) x。"),
        ("p_2", "正解：(AC)。\n\n(B) x。(D) x。(F) x。"),
        ("p_3", "正解：x"), ("p_4", "正解：(A)。"), ("p_5", "正解：(A)。"), ("p_9", "正解：(A)。"), ("p_1", None),
    ]
    path = save("explanations", [(i, q, t) for i, (q, t) in enumerate(texts)], "expl_id bigint, qid string, t string")
    got = {r["expl_id"]: (r["fault"], r["missing"], r["stray"]) for r in registry.QUERIES["prd09_letter_faults"](spark, path).collect()}
    assert got == {2: ("letters", "D", ""), 3: ("letters", "", "A"), 5: ("letters", "E", "F"), 7: ("no_options", None, None), 8: ("no_answer", None, None), 9: ("no_question", None, None)}


PACK = "pack_row bigint, pack_date date, law string, pcode string, amend_date date, articles map<string,string>, loaded_at timestamp_ntz"


def test_impacted_laws(spark, save):
    one, two = dt.date(2024, 1, 1), dt.date(2024, 4, 1)
    packs = [(one, "測試​法", "X1", {"第1條": "a", "2": "b", "3": "c", "44-3": "d"}), (two, "測試法 ", "X1", {"1": "a", "2": "B", "４": "e", "44-3": "d"}), (one, "乙法", "X2", {"1": "a"}), (two, "乙法", "X2", {"1": "a"})]
    save("anchor_packs", [(i, d, law, p, None, a, DAY) for i, (d, law, p, a) in enumerate(packs)], PACK)
    docs = ["測試法第2條、測試法第 3 條、測試法第2條", "依測試法第４條", "測試法第1條", "乙法第1條", "第2條", None]
    save("documents", list(enumerate(docs)), "doc_id bigint, text string")
    path = save("explanations", [(7, "測試​法第3條"), (8, "測試法第44條之3"), (9, None)], "expl_id bigint, t string")
    got = sorted((str(r["pack_date"]), r["src_table"], r["src_id"], r["kinds"], r["refs"]) for r in registry.QUERIES["join07_impacted_laws"](spark, path).collect())
    d = "2024-04-01"
    assert got == [(d, "documents", 0, "amended,removed", "X1 2,X1 3"), (d, "documents", 1, "added", "X1 4"), (d, "explanations", 7, "removed", "X1 3")]


def test_names_are_found_as_by_the_alternation():
    draw = random.Random(7)
    for _ in range(300):
        names = {"".join(draw.choices("甲乙法", k=draw.randint(1, 4))) for _ in range(draw.randint(1, 6))}
        text = "".join(draw.choices("甲乙丙法", k=60))
        want = [(m.start(), m.end(), m[0]) for m in re.finditer("|".join(sorted(names, key=lambda x: (-len(x), x))), text)]
        assert [(a, b, text[a:b]) for a, b in Names(names).spans(text)] == want


def test_citations_of_laws_beyond_the_former_bound(spark, save):
    rows = [(i, dt.date(2024, 1, 1), f"{chr(0x4E00 + i // 1000)}{chr(0x5E00 + i % 1000)}法", f"X{i}", None, {"1": "a"}, DAY) for i in range(20_100)]
    save("anchor_packs", rows, PACK)
    save("explanations", [(1, None)], "expl_id bigint, t string")
    path = save("documents", [(1, rows[-1][2] + "第1條"), (2, rows[-1][2] + "第2條")], "doc_id bigint, text string")
    got = registry.QUERIES["join05_citation_verdicts"](spark, path).collect()
    assert sorted((r["law"], r["status"], r["refs"]) for r in got) == [(rows[-1][2], "fail", 1), (rows[-1][2], "ok", 1)]
