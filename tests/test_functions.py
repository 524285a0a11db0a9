import pytest
from hypothesis import given, settings
from hypothesis import strategies as st_
from pyspark.sql import functions as F

from stemforge.functions import statistics as st
from stemforge.functions import textcols as tx
from stemforge.functions.brackets import halve_brackets
from stemforge.functions.lookalike import look_key, look_key_col, normal_form
from stemforge.functions.numerals import article_number, ascii_width, chinese_integer
from stemforge.operators import gates
from stemforge.operators.ranking import rank_within


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first()["y"]


@pytest.mark.parametrize(("a", "b"), [("ＡＢＣ１２", "ABC12"), ("é", "é"), ("中 文\r\n字", "中文字"), ("a​b­c︎", "abc"), ("ﬁnd", "find"), ("⼈⺠", "人民"), ("Аpple", "Apple"), ("a—b", "a―b"), ("a·b", "a‧b"), ("（甲）", "(甲)"), ("更", "更"), ("", " 　\n")])
def test_alike(a, b):
    assert look_key(a) == look_key(b)


@pytest.mark.parametrize(("a", "b"), [("x²", "x2"), ("H₂O", "H2O"), ("①", "1"), ("½", "1/2"), ("A", "a"), ("或", "與"), ("（前項）", "（前二項）")])
def test_unlike(a, b):
    assert look_key(a) != look_key(b)


@settings(max_examples=200, deadline=None)
@given(st_.text(max_size=40))
def test_fold_is_idempotent(s):
    assert look_key(look_key(s)) == look_key(s)


def test_fold_column_nulls(spark):
    rows = spark.createDataFrame([("Ａ",), (None,), ("",)], "x string").select(look_key_col(F.col("x")).alias("y")).collect()
    assert [r["y"] for r in rows] == ["A", None, ""]
    assert one(spark, "（甲）", normal_form(F.col("x"), F.lit("NFC"))) == "（甲）"
    assert one(spark, "（甲）", normal_form(F.col("x"), F.lit("NFKC"))) == "(甲)"


@pytest.mark.parametrize(("token", "value"), [("三十", 30), ("一百二十", 120), ("二〇一", 201), ("三萬", 30000), ("十二", 12), ("兩千三百", 2300), ("一億二千萬", 120_000_000), ("abc", None), ("", None), (None, None)])
def test_numerals(spark, token, value):
    assert one(spark, token, chinese_integer(F.col("x"))) == value


@pytest.mark.parametrize(("spelt", "art"), [("第44條之3", "44-3"), ("４４－３", "44-3"), ("四十四之三", "44-3"), ("第 10 條", "10"), ("007", "7"), ("附件", "附件"), (None, None)])
def test_article_numbers(spark, spelt, art):
    assert one(spark, spelt, article_number(F.col("x"))) == art


def test_width(spark):
    assert one(spark, "Ａ～！　", ascii_width(F.col("x"))) == "A~! "


@pytest.mark.parametrize(("text", "expected"), [("中 文  字 ab", "中文字 ab"), ("a\n\nb", "a b"), (" 　", ""), (None, None)])
def test_join_clean(spark, text, expected):
    assert one(spark, text, tx.join_clean(F.col("x"))) == expected


def test_marks_and_gates(spark):
    assert one(spark, "比例3:1，中文,好.", tx.full_width_marks(F.col("x"))) == "比例3:1，中文，好。"
    assert one(spark, "中文...", tx.full_width_marks(F.col("x"))) == "中文..."
    assert one(spark, "3／4 甲／乙", tx.half_width_separators(F.col("x"))) == "3/4 甲／乙"
    once = one(spark, "一\\n二\n三,四", tx.tidy_gates(F.col("x")))
    assert once == one(spark, once, tx.tidy_gates(F.col("x"))) == "一\n\n二\n\n三，四"


def test_shapes(spark):
    assert one(spark, "stem (A) x (B) y (A) z", tx.split_options(F.col("x"))) == {"A": "x", "B": "y"}
    assert one(spark, "甲乙丙 12. 下題", tx.cut_option_tail(F.col("x"))) == "甲乙丙"
    assert str(one(spark, "民國 112 年 3 月 5 日", tx.roc_date(F.col("x")))) == "2023-03-05"
    assert one(spark, "1,234.50", tx.scaled_number(F.col("x"), F.lit("萬"))) == "12345000"
    assert one(spark, "<p>a<script>x</script></p>\n<b>b</b>", tx.visible_text(F.col("x"))) == "a\nb"
    assert one(spark, "正解：(A)。\n\n(B) 錯\n\n本題考點：甲", tx.structure_faults(F.col("x"))) == []
    assert one(spark, "無", tx.structure_faults(F.col("x"))) == ["sections", "head", "tail"]
    assert one(spark, "契約 契約 王朝", tx.domain_by_words(F.col("x"), {"law": ["契約"], "history": ["王朝"]})) == "law"
    assert one(spark, "契約 王朝", tx.domain_by_words(F.col("x"), {"law": ["契約"], "history": ["王朝"]})) == ""
    assert one(spark, "a  \nb ", tx.prompt_digest(F.col("x"))) == one(spark, "a\nb", tx.prompt_digest(F.col("x")))
    assert one(spark, "</script>", tx.html_safe_json(F.col("x"))) == "<\\/script>"


def test_fingerprint_ignores_order_and_blanks(spark):
    rows = spark.createDataFrame([("題 目", {"A": "甲", "B": "乙"}), ("題目", {"A": "乙 ", "B": "甲"}), ("題目", None)], "s string, o map<string,string>")
    fp = [r["f"] for r in rows.select(tx.content_fingerprint(F.col("s"), F.col("o")).alias("f")).collect()]
    assert fp[0] == fp[1] != fp[2]


def test_statistics(spark):
    t = spark.createDataFrame([(1, 40, 3, 40), (5, 200, 15, 200), (10, 400, 30, 400)], "a int, n int, b int, m int")
    assert [round(r["p"], 4) for r in t.select(st.fisher(F.col("a"), F.col("n"), F.col("b"), F.col("m")).alias("p")).collect()] == [0.6153, 0.0365, 0.0017]
    w = t.select(*st.wilson(F.col("a"), F.col("n"))).first()
    assert (round(w[0], 3), round(w[1], 3)) == (0.004, 0.129)
    s = spark.createDataFrame([(23, 29), (0, 0)], "k int, n int").select(st.binomial_two_sided(F.col("k"), F.col("n")).alias("p")).collect()
    assert round(s[0]["p"], 4) == 0.0023 and s[1]["p"] == 1.0
    e = spark.createDataFrame([(4, 40), (3, 40)], "k int, n int").select(st.escalate(F.col("k"), F.col("n")).alias("e")).collect()
    assert [r["e"] for r in e] == [True, False]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("f（x）＝（x+1）²為真", "f(x)＝(x+1)²為真"),
        ("（non-coding RNA）+1", "（non-coding RNA）+1"),
        ("p=0.043（顯著）", "p=0.043（顯著）"),
        ("離子（Na+）", "離子（Na+）"),
        ("（A）x+1", "（A）x+1"),
        ("q（x）＝x+1，而 q（x）次數小", "q（x）＝x+1，而 q（x）次數小"),
        ("f（x＝1", "f（x＝1"),
        ("", ""),
        (None, None),
    ],
)
def test_brackets_of_formulas(text, want):
    assert halve_brackets(text) == want == halve_brackets(want)


def test_more_text_rules(spark):
    row = lambda *values: spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    first = lambda df, c: df.select(c.alias("r")).first()["r"]
    c = F.col("c0")
    assert first(row("甲。\n乙。\n丙"), tx.paragraphs_or_same(c)) == "甲。\n\n乙。\n\n丙"
    assert first(row("甲\n乙。"), tx.paragraphs_or_same(c)) == "甲\n乙。"
    assert first(row(r"\(10^2\) 與 \( I_e \) 與 \(2 \times 3\)"), tx.bare_latex(c)) == ["10^2", r"2 \times 3"]
    assert first(row("甲甲乙", "乙甲丙甲"), tx.multiset_within(c, F.col("c1"))) and not first(row("甲甲", "甲"), tx.multiset_within(c, F.col("c1")))
    page = "甲乙丙丁戊己庚辛壬癸子丑" * 2 + "寅卯辰巳午未申酉戌亥"
    assert tuple(first(row(page, "寅卯 辰巳午未申酉戌亥XX"), tx.locate(c, F.col("c1")))) == (10, 25)
    assert tuple(first(row(page, "甲乙丙丁戊己庚Z"), tx.locate(c, F.col("c1")))) == (7, 1)
    assert tuple(first(row(page, "無此文字片段"), tx.locate(c, F.col("c1")))) == (None, None)
    assert first(row("<p>a &amp;lt; b</p><script>x</script>&nbsp;&lt;i&gt;"), tx.visible_text(c)) == "a &lt; b\n<i>"


@pytest.mark.parametrize(("status", "several", "want"), [("official", "exact", False), ("official", "any", True), ("multi", "exact", True), ("free", "exact", True), ("unread", "exact", None), (None, "any", None)])
def test_grades(spark, status, several, want):
    df = spark.createDataFrame([("A", "AC", ["A"], status)], "ch string, answer string, accept array<string>, status string")
    assert df.select(gates.grade(F.col("ch"), F.col("answer"), F.col("accept"), F.col("status"), several).alias("g")).first()["g"] is want


def test_ranks_within_groups(spark):
    rows = [(g, y, i) for i, (g, y) in enumerate([("a", 3), ("a", 1), ("a", None), (None, 1), ("a", 1), (None, None)])]
    df = spark.createDataFrame(rows, "g string, y int, i int")
    got = {r["i"]: r["k"] for r in rank_within(df, ["g"], F.col("y"), ["i"], "k").collect()}
    assert got == {1: 1, 4: 2, 0: 3, 2: 4, 3: 1, 5: 2}
