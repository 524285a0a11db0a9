"""Queries whose cases the test tables hardly have, on planted rows, against their SQL; and mutations that have to turn a comparison red."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stemforge.functions import textcols as tx
from stemforge.operators import gates, parity, parsing
from stemforge.plans import registry
from tests import test_queries
from tests.test_queries import compare

DAY = dt.datetime(2024, 1, 1)
BANK = "row_id bigint, qid string, exam string, year int, subject string, no int, type string, stem string, options map<string,string>, answer string, accept array<string>, group_id string, passage string, figure string, answer_status string, answer_src string, table_md string, parse string, loaded_at timestamp_ntz"
LONG = "甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉戌亥，何者正確？"


def bank_rows():
    kinds = [
        {"stem": "中,文;半形:標點!何者？"},
        {"stem": "①甲①乙②丙。"},
        {"stem": "①甲②乙①丙。", "no": 9},
        {"stem": "何者正確？甲乙丙"},
        {"stem": "「引文何者？", "options": {"A": "「甲", "B": "乙」「丙」", "C": ""}},
        {"stem": "甲更", "options": {"A": ""}},
        {"stem": "共得 mg。", "figure": "x.png"},
        {"stem": "12345 與 678 何者？", "figure": "y.png"},
        {"stem": "甲？", "options": {"A": "尾巴 " + LONG, "B": "乙 第 3 頁 共 8 頁 國文", "C": "丙"}},
        {"stem": LONG, "options": {"B": "甲", "A": "甲"}},
        {"stem": "承上題，何者錯誤？", "options": {"A": "甲", "C": "丙"}},
        {"stem": None, "options": None, "answer": "ＡＣ", "accept": ["A", "C"]},
        {"stem": "", "options": {}, "answer": "／"},
        {"stem": "改後？", "options": {"A": "甲"}, "no": 13},
        {"stem": "組合？", "options": {"A": "僅①②", "B": "① ②", "C": "①③①"}, "no": 15},
        {"stem": "排序？", "options": {"A": "①②③", "B": "①③②", "C": "③②①", "D": "\ue010甲"}, "no": 16},
        {"stem": "排序？", "options": {"A": "①②", "B": "②①", "C": "②①"}, "no": 17},
    ]
    out = []
    for i, k in enumerate(kinds):
        no = k.get("no", i + 1)
        row = {"row_id": i, "qid": f"卷_{no}", "exam": "甲考", "year": 111, "subject": "國文", "no": no, "type": "單選", "answer": "A", "answer_status": "official", "answer_src": "key_pdf", "parse": "ok", "loaded_at": DAY + dt.timedelta(days=i), **k}
        out.append(tuple(row.get(c.split(" ")[0]) for c in BANK.split(", ")))
    return out


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("planted"))
    save = lambda name, rows, kind: spark.createDataFrame(rows, kind).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    save("bank", bank_rows(), BANK)
    texts = ["正解：(A)。\n\n解析。\n\n本題考點：甲。", "解析。以上解析僅供參考。", "解析，信心為中。", None, "中文,半形.結束", "故選(B)。\r\n甲。"]
    save("explanations", [*((i, f"卷_{i}", t, "high", DAY) for i, t in enumerate(texts)), (13, "卷_13", "(A) 甲。(B) 乙。", "low", DAY)], "expl_id bigint, qid string, t string, c string, merged_at timestamp_ntz")
    save("anchor_packs", [(1, "民法"), (2, "丁民法"), (3, "甲乙民法"), (4, "_民法_！"), (5, None)], "pack_row bigint, law string")
    save("figure_files", [("a.png", "s"), ("b.png", "s"), ("x.png", "u")], "filename string, sha1 string")
    save("documents", [(1, "甲,乙.丙"), (2, "a,b"), (3, None)], "doc_id bigint, text string")
    return path


NAMES = [
    "prd07_anomalous_signs", "prd11_boilerplate", "prd12_leaked_confidence", "prd13_half_marks", "prd14_equal_options", "prd15_repeated_marks", "prd17_text_after_mark", "prd18_marks_in_order", "prd19_quote_balance",
    "prd20_option_bleed", "prd22_orphan_units", "prd24_option_furniture", "drv22_digit_tails", "join04_number_gaps", "join20_name_suffixes", "dup05_shared_files", "nrm08_full_width_marks", "nrm19_safe_names", "prd10_conclusion",
    "prd08_structure", "par09_question_types", "agg03_paper_completeness", "nrm07_answer_width", "join09_figure_both_ways", "par12_answer_remarks", "drv09_recheck", "prd14_option_collapse", "set07_unregistered_keys",
]


@pytest.mark.parametrize("name", NAMES)
def test_planted_rows_come_out(spark, planted, monkeypatch, name):
    monkeypatch.setattr(test_queries, "DATA", planted)
    compare(spark, registry.QUERIES, registry.SQL, name)
    assert registry.QUERIES[name](spark, planted).count() > 0


@pytest.mark.parametrize(
    ("name", "where", "what", "by"),
    [
        ("nrm19_safe_names", tx, "safe_name", lambda c: F.trim(F.regexp_replace(c, r"[^0-9A-Za-z_一-鿿]+", "_"))),
        ("prd15_repeated_marks", tx, "repeated_mark", lambda c: c.rlike("①[^①-⑩]*②")),
        ("prd20_option_bleed", parsing, "bleeds", lambda o, n: F.array_sort(F.map_keys(o))),
        ("prd19_quote_balance", tx, "quotes_balance", lambda c: F.regexp_count(c, F.lit("「")) >= F.regexp_count(c, F.lit("」"))),
        ("prd17_text_after_mark", tx, "text_after_question", lambda c: c.rlike("？")),
        ("nrm07_answer_width", tx, "fold_answer", lambda c: F.translate(c, "ＡＢ", "AB")),
        ("agg03_paper_completeness", gates, "completeness", lambda r, p, n: r.groupBy(p).agg(F.count(n).alias("rows"), F.max(n).alias("declared"), F.lit(0).cast("bigint").alias("missing"), F.lit("").alias("gaps"))),
    ],
)
def test_a_mutation_turns_the_comparison_red(spark, planted, monkeypatch, name, where, what, by):
    monkeypatch.setattr(test_queries, "DATA", planted)
    monkeypatch.setattr(where, what, by)
    with pytest.raises(AssertionError):
        compare(spark, registry.QUERIES, registry.SQL, name)


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f(F.col("t")).alias("r")).first()["r"]


def test_section_bounds(spark):
    assert tuple(one(spark, "甲\n說 明：第 1 題至第 57 題為單選題\n乙\n第 貳 部 分\n第貳部分", parsing.section_bounds)) == (57, 3)
    assert tuple(one(spark, "甲", parsing.section_bounds)) == (None, 1)


def test_group_headers(spark):
    text = "3-5 為題組\n文一\n3. 問\n為題組\n8-9\n文二\n◎ 引文\n8. 問\n11－12\n為 題 組\n文三\n20-90為題組\n文四\n"
    df = spark.createDataFrame([("p", text)], "k string, t string")
    got = {r["no"]: (r["a"], r["b"], r["passage"]) for r in parsing.group_members(df, "k", "t").collect()}
    assert got == {**{n: (3, 5, "文一") for n in (3, 4, 5)}, **{n: (8, 9, "文二 ◎ 引文") for n in (8, 9)}, **{n: (11, 12, "文三") for n in (11, 12)}}


def test_split_questions(spark):
    text = "頁首\n1. 甲\n99. 不是題\n2．乙 (A) 一\n1. 殘影\n為題組\n3. 丙"
    df = spark.createDataFrame([("p", text), ("q", None), ("r", "")], "k string, t string")
    got = {r["no"]: r["segment"].strip() for r in parsing.split_questions(df, "k", "t").collect()}
    assert got == {1: "甲\n99. 不是題", 2: "乙 (A) 一\n1. 殘影", 3: "丙"}


def test_answer_remarks(spark):
    got = [tuple(r) for r in one(spark, "1 A\n備 註：第16題一律給分，第1題答案Ａ或Ｃ均可。\n第2題答案更正為D。另注意。", parsing.answer_remarks)]
    assert got == [(16, "free", ""), (1, "multi", "AC"), (2, "changed", "D")]
    assert one(spark, "1 A", parsing.answer_remarks) == []


def test_law_pages(spark):
    page = "採石法\n修正日期：民國 112 年 3 月 5 日\n第 1 條\n採石者應登記。\n第 一 章 總則\n第 2-1 條\n期限\n三十日。\n最新訊息\n頁尾"
    assert [tuple(a) for a in one(spark, page, parsing.law_articles)] == [("1", "採石者應登記。"), ("2-1", "期限 三十日。")]
    assert one(spark, page, lambda c: parsing.law_page_faults(c, F.lit("採石法"))) == []
    assert one(spark, "水井法\n第 1 條\n第 1 條\n甲", lambda c: parsing.law_page_faults(c, F.lit("採石法"))) == ["name", "empty", "repeated", "date"]
    assert one(spark, "", lambda c: parsing.law_page_faults(c, F.lit("採石法"))) == ["name", "headings", "date"]


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("１１２學測數學Ａ試卷.pdf", (112, "math_a", "試卷", "")),
        ("112學測數學答案", (112, "math", "答案", "")),
        ("112學測國文英文試題", (112, None, "試卷", "subjects")),
        ("112學測英文答題卷", (112, "english", None, "kind")),
        ("212學測英文試卷", (None, "english", "試卷", "year")),
        ("", (None, None, None, "year")),
    ],
)
def test_file_classes(spark, name, want):
    subjects = {"國文": "chinese", "英文": "english", "數學": "math", "數學a": "math_a"}
    assert tuple(one(spark, name, lambda c: parsing.classify_file(c, subjects))) == want


def test_shared_cases(spark):
    text = "情況題：病人甲入院。第 3 題至第 5 題\n情況題一：乙。第9題至第7題\n情況題：丙。第1題至第40題\n情況題：" + "長" * 700 + "第1題至第2題"
    assert [tuple(c) for c in one(spark, text, parsing.shared_cases)] == [(3, 5, "病人甲入院。")]


def test_parity_states(spark):
    at = lambda n: DAY + dt.timedelta(days=n)
    ledger = [("1", "a", "x", "x", "agent", at(2)), ("1", "b", "x", "x", "agent", at(2)), ("2", "a", "x", None, "cli", at(2)), ("2", "b", "y", "y", "agent", at(2)), ("3", "a", "x", "z", "agent", at(2)), ("3", "b", "x", None, "agent", at(2)), ("4", "a", "x", "x", "agent", at(0)), ("4", "a", "x", "x", "agent", at(1)), ("9", "a", "x", "x", "agent", at(2))]
    rows = spark.createDataFrame(ledger, "block string, arm string, prompt_sha string, delivered_sha string, channel string, ts timestamp_ntz")
    blocks = spark.createDataFrame([(b, at(1) if b != "4" else at(2)) for b in "1234"] + [("5", None)], "block string, newer_than timestamp_ntz")
    arms = spark.createDataFrame([("a",), ("b",)], "arm string")
    got = {(r["block"], r["arm"]): r["state"] for r in parity.parity(rows, arms, blocks).collect()}
    assert got == {("1", "a"): "ok", ("1", "b"): "ok", ("2", "a"): "unequal", ("2", "b"): "unequal", ("3", "a"): "drift", ("3", "b"): "unverified", ("4", "a"): "stale", ("4", "b"): "missing", ("5", "a"): "missing", ("5", "b"): "missing"}
    t = spark.createDataFrame([("a  \nb ",), ("a\nb",), ("a\nc /p/1",), ("a\nc /p/2",)], "t string")
    assert len({r["prompt_sha"] for r in parity.record(t, F.col("t")).collect()}) == 3




@pytest.mark.parametrize(("text", "pool", "want"), [("題幹。甲乙甲", "乙甲甲", "題幹。"), ("題幹甲", "乙甲", "題幹甲"), ("甲乙", "乙甲", ""), ("", "甲", ""), (None, "甲", None), ("甲", None, "甲")])
def test_cut_pool(text, pool, want):
    assert parsing.cut_pool(text, pool) == want


def test_unrotated(spark):
    df = spark.createDataFrame([(1, "3", ["4", "5", ""], ["3", "4", "5"]), (2, "3", ["4", "5", ""], ["4", "5", "9"]), (3, "", ["3", "4", "5"], ["3", "4", "5"]), (4, None, None, None)], "i int, tail string, n array<string>, src array<string>")
    got = {r["i"]: r["r"] for r in df.select("i", parsing.unrotated(F.col("tail"), F.col("n"), F.col("src")).alias("r")).collect()}
    assert got == {1: ["3", "4", "5"], 2: ["4", "5", ""], 3: ["3", "4", "5"], 4: None}


def test_glyphs_mean_something_within_their_paper_and_font(spark):
    texts = spark.createDataFrame([(1, "p", "f", "甲乙"), (2, "q", "f", "甲"), (3, "p", "g", ""), (4, "p", "f", None)], "id int, paper string, font string, text string")
    glyphs = spark.createDataFrame([("p", "f", "", "α"), ("p", "f", "", "α"), ("q", "f", "", "β")], "paper string, font string, seen string, true string")
    got = {r["id"]: (r["text"], r["unknown"]) for r in parsing.repair_glyphs(texts, glyphs).collect()}
    assert got == {1: ("甲α乙", 1), 2: ("甲β", 0), 3: ("", 1), 4: (None, None)}
    two = glyphs.unionByName(spark.createDataFrame([("p", "f", "", "γ")], glyphs.schema))
    with pytest.raises(Exception, match="two meanings"):
        parsing.repair_glyphs(texts, two).collect()


def test_items_by_position(spark):
    lines = ["頁首", "3. 下列何者為正確的敘述內容", "(A) 一 (B) 二", "(C) 三 (D) 四", "4. 短題目甲乙丙", "(A) 一"]
    df = spark.createDataFrame([("d", 0, 50.0, float(i), x) for i, x in enumerate(lines)][::-1], "doc string, page int, x0 double, y0 double, text string")
    got = {r["no"]: (r["stem"], r["options"]) for r in parsing.items_by_position(df).collect()}
    assert got == {3: ("下列何者為正確的敘述內容", {"A": "一", "B": "二", "C": "三", "D": "四"}), 4: (None, None)}
