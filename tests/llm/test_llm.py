"""Operators for training text against brute force, round trips and their defined edge cases."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stemforge.functions.lookalike import look_key
from stemforge.llm.area_model import Linear, calibrate, document_areas, features, fit_areas, paragraphs
from stemforge.llm.areas import _sample, classify, path_of, train, weak_rules
from stemforge.llm.canonical import Scores, canonical_column, decode, fit_scores
from stemforge.llm.mixing import largest_error, plan, sample, shares
from stemforge.llm.neardup import near_pairs, prefix_length, sequences, signatures
from stemforge.llm.noisy_channel import Channel, Reader, align, count_texts
from stemforge.llm.packing import BestFit, pack
from stemforge.llm.scan_layout import Furniture, parse, seams
from stemforge.llm.scan_repair import repair
from stemforge.llm.tokens import TOKENIZER, token_count


# --- look-alike lattices


def test_canonical_equal_exactly_if_alike(spark):
    texts = ["Аpple пирог", "Apple пирог", "apple", "ａｐｐｌｅ", "Москва", "x²", "x2", "é", "é", "", " 　", None, "一​二", "一二"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    scores = fit_scores((df, "t"))
    form = {r["i"]: r["f"] for r in df.select("i", canonical_column(scores, F.col("t")).alias("f")).collect()}
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert (form[i] == form[j]) == (look_key(a) == look_key(b)), (a, b)
    assert form[11] is None and form[9] == ""


def test_lattice_keeps_one_script():
    pairs = [("^", "c", 50), ("c", "a", 50), ("a", "t", 50), ("t", "^", 50), ("^", "М", 30), ("М", "о", 30), ("о", "с", 30), ("с", "к", 30), ("к", "в", 30), ("в", "а", 30), ("а", "^", 30)]
    scores = Scores([*pairs, *((a, None, n) for a, _, n in pairs)])
    assert decode("cat", scores) == "cat"
    assert decode(look_key("Москва"), scores) == "Москва"
    assert look_key(decode("cat", scores)) == "cat"


def test_kana_stay_kana(spark):
    texts = ["ロボット", "口ボッ卜", "カニ", "力學", "二口", "人口", "カメラ", "メニュー", "力", "口"] + ["力學"] * 9 + ["人口"] * 9
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    form = {r["t"]: r["f"] for r in df.select("t", canonical_column(fit_scores((df, "t")), F.col("t")).alias("f")).collect()}
    assert form["ロボット"] == form["口ボッ卜"] == "ロボット" and form["カメラ"] == "カメラ" and form["メニュー"] == "メニュー"
    assert form["力學"] == "力學" and form["人口"] == "人口" and form["口"] == "口"


@pytest.mark.parametrize(("a", "b"), [("ρ", "p"), ("υ", "u"), ("κ", "к"), ("ɡ", "g"), ("ı", "i")])
def test_look_alikes(a, b):
    assert look_key(a) == look_key(b) != look_key(b.upper())


# --- scanned pages


FURNITURE = Furniture(["國文"])


@pytest.mark.parametrize(
    ("text", "lines", "headers", "pages"),
    [
        ("甲乙\n第7頁\n丙丁。", ["甲乙", "丙丁。"], 0, 1),
        ("甲乙\n— 二十七 —\n丙丁。", ["甲乙", "丙丁。"], 0, 1),
        ("國　文　考　科\n甲乙。", ["甲乙。"], 1, 0),
        ("第 4 頁　共 5 頁　國文考科\n甲。", ["甲。"], 1, 0),
        ("達到32  請翻頁繼續作答  5萬元。", ["達到325萬元。"], 1, 0),
        ("the  Turn over the page  Council", ["the Council"], 1, 0),
        ("抄錄在筆記第 400 頁。", ["抄錄在筆記第 400 頁。"], 0, 0),
        ("The Paper Lantern Society published 59 pages.", ["The Paper Lantern Society published 59 pages."], 0, 0),
        ("", [], 0, 0),
        (" \n　", [], 0, 0),
    ],
)
def test_layout(text, lines, headers, pages):
    p = parse(text, FURNITURE)
    assert (p.lines, len(p.headers), len(p.pages)) == (lines, headers, pages)


@pytest.mark.parametrize(
    ("lines", "text", "kinds"),
    [
        (["a mono-", "poly came"], "a monopoly came", {"hyphen"}),
        (["a well-", "known one"], "a well-known one", {"break"}),
        (["中文斷", "行了。"], "中文斷行了。", {"break"}),
        (["前提。", "甲、一。", "乙、二。", "何者正確？"], "前提。\n甲、一。\n乙、二。\n何者正確？", set()),
        (["句一。", "句二。"], "句一。句二。", set()),
        ([], "", set()),
    ],
)
def test_seams(lines, text, kinds):
    known = {"well-known": 9}
    assert seams(lines, lambda w: known.get(w, 0)) == (text, kinds)


def test_channel_repairs_by_context():
    texts = ["轉換敘述視角"] * 200 + ["轉換敘迷視角", "甲村村民迷路", "村民迷路"] * 2 + ["the freestyle heat within"] * 500
    reader = Reader(count_texts(texts), Channel({}))
    assert reader.read("轉換敘迷視角") == ("轉換敘述視角", 1)
    assert reader.read("村民迷路") == ("村民迷路", 0)
    assert reader.read("the freesty1e heat vvithin") == ("the freestyle heat within", 2)
    assert reader.read("共B23筆")[0] == "共823筆"
    assert reader.read("第�組")[1] == 1
    assert reader.read("") == ("", 0)


def test_readings_are_the_best_of_all_paths():
    draw = random.Random(11)
    for _ in range(60):
        signs = "甲乙丙丁戊"
        texts = ["".join(draw.choices(signs, k=30)) for _ in range(40)]
        reader = Reader(count_texts(texts), Channel({}))
        segments = []
        for _ in range(draw.randint(1, 5)):
            segments.append([(draw.choice(signs), 0, 0.0), *((x, 1, -draw.random()) for x in {"".join(draw.choices(signs, k=draw.randint(1, 2))) for _ in range(3)})])
            segments.append([(draw.choice(["", "甲"]), 0, 0.0)])
        segments.append([("丙丁", 0, 0.0)])
        paths = [("", 0, 0.0)]
        for s in segments:
            paths = [(p + o, n + r, c + x) for p, n, c in paths for o, r, x in s]

        def score(p):
            w = reader._windows("甲乙", p, "")
            return sum(np.log(n + 0.02) for n in w) / len(w) * 3

        want = max(score(p) + c for p, n, c in paths if n)
        assert abs(max(x for _, _, x in reader._readings("甲乙", segments)) - want) < 1e-9


def test_pairs_of_words_decide():
    texts = ["a cornet shines at night"] * 60 + ["a comet shines at night"] * 60 + ["the cornet player rests"] * 60 + ["the bright comet passed"] * 60
    reader = Reader(count_texts(texts), Channel({("rn", "m"): 0.05}))
    assert reader.read("the bright cornet passed")[0] == "the bright comet passed"
    assert reader.read("the cornet player rests")[0] == "the cornet player rests"


def test_long_headers_and_long_words():
    line = "國文考科　第 1 頁　共 9 頁　" * 50
    assert parse(line + "\n甲。", FURNITURE).lines == ["甲。"]
    assert parse("1" * 5_000 + "甲", FURNITURE).lines == ["1" * 5_000 + "甲"]
    many = "1 " * 20_000 + "考科x"
    assert parse(many, FURNITURE).lines == [many]
    assert len(seams(["甲乙丙"] * 50_000, lambda w: 0)[0]) == 150_000
    reader = Reader(count_texts([]), Channel({}))
    assert reader.read("l" * 50_000)[0] == "l" * 50_000


def test_align_finds_confusions():
    assert list(align("甲白勺乙", "甲的乙")) == [("白勺", "的")]


def test_repair_edges(spark):
    rows = [(1, None), (2, ""), (3, "　\n"), (4, "第3頁"), (5, "甲" * 50_000 + "。"), (5, "乙。")]
    df = spark.createDataFrame(rows, "row_id long, stem string")
    out = repair(df, "row_id", "stem").collect()
    assert len(out) == len(rows)
    by = collections.defaultdict(list)
    for r in out:
        by[r["row_id"]].append((r["text"], r["kinds"]))
    assert by[1] == [(None, [])] and by[2] == [("", [])] and by[3] == [("", [])] and by[4] == [("", ["pageno"])]
    assert sorted(len(t) for t, _ in by[5]) == [2, 50_001]
    assert repair(df.limit(0), "row_id", "stem").collect() == []


# --- near duplicates


def brute(docs, t):
    sets = {d: set(sequences(x, 4).tolist()) for d, _, x in docs}
    part = {d: p for d, p, _ in docs}
    out = set()
    for a in sets:
        for b in sets:
            if a < b and part[a] == part[b] and sets[a] and sets[b]:
                o = len(sets[a] & sets[b])
                if o / len(sets[a] | sets[b]) >= t - 1e-12:
                    out.add((a, b))
    return out


@pytest.mark.parametrize("t", [0.6, 0.8])
def test_near_pairs_match_brute_force(spark, t):
    rng = random.Random(3)
    docs = []
    for i in range(120):
        base = "".join(rng.choice("甲乙丙丁戊己庚辛壬癸子丑寅卯") for _ in range(rng.randint(5, 80)))
        docs.append((len(docs), i % 2, base))
        for _ in range(rng.randint(0, 3)):
            s = list(base)
            for _ in range(rng.randint(0, 6)):
                s[rng.randrange(len(s))] = rng.choice("甲乙丙丁")
            docs.append((len(docs), i % 2, "".join(s)))
    docs += [(1000, 0, ""), (1001, 0, "甲乙"), (1002, 0, "甲乙丙丁"), (1003, 0, "甲乙丙丁")]
    df = spark.createDataFrame([*docs, (2000, 0, None), (2001, None, "甲乙丙丁")], "doc long, part int, text string")
    for block, task in ((2_000, 1_000_000), (3, 200)):
        got = [(r["doc_a"], r["doc_b"]) for r in near_pairs(df, t, block=block, task=task).collect()]
        assert set(got) == brute(docs, t) and len(got) == len(set(got))
    assert near_pairs(df.limit(0), t).collect() == []


def test_prefix_length():
    assert prefix_length(10, 0.6) == 5 and prefix_length(1, 0.6) == 1


# --- packing


def test_packing_round_trip(spark):
    rng = random.Random(5)
    items = [(i, rng.choice([0, 1, 7, 40, 99, 100, 101, 350])) for i in range(500)] + [(7, 40), (9999, None)]
    df = spark.createDataFrame(items, "doc_id long, tokens long")
    specs = spark.createDataFrame([("s", 100), ("none", 0)], "spec string, capacity_tokens int")
    out = pack(df, specs, shard_items=200, documents_per_token=0.25, attention_share=1.0).collect()
    fill = collections.Counter()
    docs = collections.Counter()
    for r in out:
        fill[r["container"]] += r["tokens"]
        docs[r["container"]] += 1
    assert max(fill.values()) <= 100 and max(docs.values()) <= 25 and {r["spec"] for r in out} == {"s"}
    assert sum(fill.values()) == sum(t or 0 for _, t in items)
    long = {i for i, t in items if (t or 0) > 100}
    assert {r["doc_id"] for r in out if r["piece"] > 0} == long
    assert sum(fill.values()) / (100 * len(fill)) > 0.9
    assert pack(df.limit(0), specs).collect() == []


def test_best_fit_obeys_all_capacities():
    bins = BestFit(100, 3, 100.0**2)
    places = [bins.place(10) for _ in range(7)]
    assert max(collections.Counter(places).values()) == 3
    tight = BestFit(100, 10, 60.0**2)
    assert tight.place(60) != tight.place(40)
    assert tight.place(90) == 2


@pytest.mark.parametrize(("sizes", "limits", "by"), [([50] * 40, {}, "tokens"), ([5] * 40, {"documents_per_token": 0.04}, "documents"), ([40] * 40, {"attention_share": 0.2}, "attention")])
def test_each_capacity_closes_containers(spark, sizes, limits, by):
    items = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, tokens long")
    specs = spark.createDataFrame([("s", 100)], "spec string, capacity_tokens int")
    out = pack(items, specs, **{"documents_per_token": 1.0, "attention_share": 1.0, **limits}).collect()
    bins = collections.Counter(r["container"] for r in out)
    assert {r["closed_by"] for r in out} == {by}
    assert max(bins.values()) == {"tokens": 2, "documents": 4, "attention": 1}[by] and len(out) == 40


# --- mixing


def test_mixing_shares_and_caps(spark):
    rows = [(i, "a", 10 + i % 7) for i in range(3000)] + [(10_000 + i, "b", 20) for i in range(300)] + [(20_000 + i, "c", 5) for i in range(50)] + [(30_000, "x", 5), (30_001, None, 5), (30_002, "a", 0)]
    sizes = spark.createDataFrame(rows, "doc_id long, source string, tokens long")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.4, 3), ("c", 0.1, 4), ("gone", 0.2, 1)], "source string, target_share double, max_repeats int")
    planned = plan(sizes, targets)
    used = sample(sizes, planned)
    report = {r["source"]: r for r in shares(planned, used).collect()}
    assert report["gone"]["actual_share"] == 0
    assert abs(report["a"]["actual_share"] / report["b"]["actual_share"] - 1.25) < 0.05
    cap = {"a": 1, "b": 3, "c": 4}
    assert all(r["copies"] <= cap[r["source"]] for r in used.collect())
    assert {r["source"] for r in used.select("source").distinct().collect()} == {"a", "b", "c"}
    assert largest_error(shares(planned, used)) < 0.15
    assert sample(sizes.limit(0), plan(sizes.limit(0), targets)).collect() == []


def test_expected_copies_are_met(spark):
    sizes = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.lit(3).cast("long").alias("tokens"))
    targets = spark.createDataFrame([("a", 1.0, 2)], "source string, target_share double, max_repeats int")
    got = sample(sizes, plan(sizes, targets, total=4500.0)).agg(F.sum("copies")).first()[0]
    assert abs(got - 1500) <= 1


# --- areas


def make_docs(n, seed):
    rng = random.Random(seed)
    words = {"law": ["契約", "抗告", "時效", "公證"], "sport": ["決賽", "跑道", "教練", "球員"], "art": ["書法", "雕刻", "畫室", "陶藝"]}
    out = []
    for _ in range(n):
        have = rng.sample(sorted(words), rng.choice([1, 1, 2]))
        out.append(("\n".join("，".join("此處論及" + rng.choice(words[a]) for _ in range(5)) + "。" for a in have), set(have)))
    return out


def test_areas_held_out():
    areas = ["art", "law", "sport"]
    model = fit_areas(make_docs(150, 1), areas)
    calibrate(model, make_docs(60, 2))
    test = make_docs(80, 3)
    found = document_areas(model, [t for t, _ in test])
    hits = sum(set(f) == have for f, (_, have) in zip(found, test))
    assert hits >= 76
    assert document_areas(model, [None, "", " \n"]) == [[], [], []]


def test_area_features():
    a, own = features(["甲乙 cat", "", "Cat"])
    assert set(own.tolist()) == {0, 2}
    assert set(a[own == 2]) <= set(a[own == 0])
    assert paragraphs(" a \n\n b\r\n") == ["a", "b"] and paragraphs(None) == []
    assert np.isfinite(Linear(["x"]).scores(["甲" * 10_000])).all()


def test_classify_edges(spark):
    docs = make_docs(120, 4)
    rows = [(i, t, "s", f"S-{i}") for i, (t, _) in enumerate(docs)] + [(900, None, None, None), (901, "", "s", None), (902, docs[0][0], "other", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, origin string")
    labels = spark.createDataFrame([(i, a) for i, (_, have) in enumerate(docs) for a in have], "doc_id long, area string")
    model = train(df, labels, ["art", "law", "sport"])
    got = collections.defaultdict(set)
    for r in classify(df, model).collect():
        got[r["doc_id"]].add(r["area"])
    assert not got[900] and not got[901] and got[902] == got[0]
    assert sum(got[i] == have for i, (_, have) in enumerate(docs)) >= 112
    assert not train(df, labels.limit(0), ["art"]).w.any()


# --- tokens


def test_token_counts(spark):
    pytest.importorskip("tiktoken")
    import os

    if not os.path.exists(TOKENIZER):
        pytest.skip("no tokenizer file")
    df = spark.createDataFrame([("hello world",), ("",), (None,), ("<|endoftext|>",)], "t string")
    n = [r["n"] for r in df.select(token_count(F.col("t")).alias("n")).collect()]
    assert n[0] == 2 and n[1] == n[2] == 0 and n[3] > 1


def test_signatures_fold():
    a = np.unique(np.random.default_rng(1).integers(0, 2**63, 300).astype(np.uint64))
    wide = np.frombuffer(signatures(a, np.zeros(len(a), np.int64), np.array([300]))[0], np.uint64)
    half = np.frombuffer(signatures(a, np.zeros(len(a), np.int64), np.array([200]))[0], np.uint64)
    assert len(wide) == 16 and len(half) == 8 and (wide[:8] | wide[8:] == half).all()


def test_weak_labels_add_what_they_promise():
    rng = random.Random(8)
    areas = ["art", "law", "sport"]
    gold = make_docs(12, 21)
    rules = weak_rules([("s", "LAW-7", {"law"})] * 30 + [("s", "LAW-9", {"art"})] * 10 + [("t", "X-1", {"sport"})] * 200 + [(None, None, {"law"})])
    assert rules == {("s", "LAW-"): {"law": 0.75}}
    docs = make_docs(400, 22)
    weak = [(t, {"law": 0.75}) for t, have in docs if "law" in have or rng.random() < 0.2]
    test = make_docs(80, 23)
    hits = [sum(set(f) == have for f, (_, have) in zip(document_areas(m, [t for t, _ in test]), test)) for m in (fit_areas(gold, areas), fit_areas(gold, areas, weak=weak))]
    assert hits[1] >= hits[0] - 2
    assert path_of("HB-12/3") == "HB-" and path_of(None) == ""


def test_training_sample_is_bounded_by_characters(spark):
    docs = make_docs(60, 24)
    df = spark.createDataFrame([(i, t, "s", "A-1") for i, (t, _) in enumerate(docs)] + [(99, "長" * 5_000, "s", "A-1")], "doc_id long, text string, source string, origin string")
    rows = _sample(df, [*range(40), 99], 1_000)
    assert 0 < sum(len(r["text"]) for r in rows) <= 1_000 and 99 not in {r["doc_id"] for r in rows}
