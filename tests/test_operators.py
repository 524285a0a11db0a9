import datetime as dt

import pytest
from pyspark.sql import functions as F

from stemforge import session
from stemforge.operators import gates, maintain
from stemforge.operators.blocks import expand_pairs, grouped_pairs
from stemforge.operators.citations import citations, key_numbers, key_numbers_col, normalize_numerals, numeral_value, verdicts
from stemforge.operators.orphans import Ledger, apply_deltas, ever_orphans, existence_deltas, orphan_keys, orphan_references, reference_deltas, reference_key
from stemforge.operators.snapshots import PAGE, SnapshotStore, key_dictionary, latest_rows, snapshot_changes


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def snap(spark, data):
    return spark.createDataFrame(data, "seq int, key string, v string").select("seq", "key", F.unhex(F.md5(F.coalesce("v", F.lit("∅")).cast("binary"))).alias("digest"))


def test_snapshot_changes(spark):
    data = [(1, "a", "x"), (1, "b", "y"), (2, "a", "x"), (2, "c", "z"), (3, "a", "q"), (3, "c", "z"), (3, None, "n")]
    assert rows(snapshot_changes(snap(spark, data))) == [(2, "b", "removed"), (2, "c", "added"), (3, "a", "changed")]


def test_snapshot_gap_counts_as_empty(spark):
    data = [(1, "a", "x"), (3, "a", "x"), (1, "k", "x"), (2, "k", "x"), (3, "k", "x")]
    assert rows(snapshot_changes(snap(spark, data))) == [(2, "a", "removed"), (3, "a", "added")]
    assert snapshot_changes(snap(spark, [])).collect() == []


def test_snapshot_repeated_rows_and_ties(spark):
    data = [(1, "a", "x"), (1, "a", "x"), (2, "a", "x"), (2, "a", "x")]
    assert rows(snapshot_changes(snap(spark, data))) == []


def test_dense_containers_match_brute_force(spark):
    a = {f"k{i}": "1" for i in range(9000)}
    b = {f"k{i}": str(1 + (i % 50 == 0)) for i in range(200, 9300)}
    df = snap(spark, [(1, k, v) for k, v in a.items()] + [(2, k, v) for k, v in b.items()])
    got = set(rows(snapshot_changes(df, key_dictionary(df, None, per_bucket=10**6))))
    want = {(2, k, "added") for k in b.keys() - a.keys()} | {(2, k, "removed") for k in a.keys() - b.keys()} | {(2, k, "changed") for k in a.keys() & b.keys() if a[k] != b[k]}
    assert got == want and PAGE == 65536


def test_ordinals_persist(spark):
    first = key_dictionary(spark.createDataFrame([("a",), ("b",), (None,)], "key string"), None, per_bucket=1)
    first.cache().count()
    more = key_dictionary(spark.createDataFrame([("c",), ("b",)], "key string"), first)
    old = {r["key"]: (r["bucket"], r["pos"]) for r in first.collect()}
    new = {r["key"]: (r["bucket"], r["pos"]) for r in more.collect()}
    assert {k: new[k] for k in old} == old and set(new) == {"a", "b", "c"} and len(set(new.values())) == 3


def test_latest_rows(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "y")], "k string, t int, v string")
    assert rows(latest_rows(df, ["k"], ["t"])) == [("a", 2, None), ("b", 1, "y")]


T0 = dt.datetime(2024, 1, 1)


def day(n):
    return T0 + dt.timedelta(days=n)


def test_orphans(spark):
    refs = [("r", 1, "t", "a", day(5)), ("r", 2, "t", "a", day(1)), ("r", 3, "t", "zz", day(5)), ("r", 4, "t", None, day(5)), ("r", 5, "t", "b", day(9)), ("r", 6, "t", "b", day(8)), ("r", 7, "t", "b", None), ("r", 8, "t", "zz", None), ("r", 9, "t", "c", day(3))]
    targets = [("t", "a", day(2), None), ("t", "a", day(4), None), ("t", "b", day(2), day(9)), ("t", "b", day(3), day(9)), ("t", "c", day(1), day(2)), ("t", "c", day(1), None)]
    r = spark.createDataFrame(refs, "src_table string, src_id long, target string, key string, at timestamp_ntz")
    t = spark.createDataFrame(targets, "target string, key string, born timestamp_ntz, gone timestamp_ntz")
    want = [(2, "late"), (3, "missing"), (5, "deleted"), (8, "missing")]
    ledger = lambda r, t: apply_deltas(None, reference_deltas(r).unionByName(existence_deltas(t)))
    for share in (0.005, 2.0):
        assert rows(orphan_references(r, ledger(r, t), hot_share=share).select("src_id", "reason")) == want
    assert rows(ever_orphans(ledger(r, t)).select("key")) == [("a",), ("b",), ("zz",)]
    assert orphan_references(r.limit(0), ledger(r.limit(0), t)).collect() == []
    assert {x["reason"] for x in orphan_references(r, ledger(r, t.limit(0))).collect()} == {"missing"}


def test_ledger_by_deliveries_equals_one_run(spark, tmp_path):
    refs = [("t", f"k{i % 7}", 1 if i % 5 else -1, 0, day(i)) for i in range(60)] + [("t", None, 1, 0, day(0)), ("t", "k1", 1, 0, None)]
    made = [("t", f"k{i % 9}", 0, 1, day(i)) for i in range(0, 60, 4)] + [("t", f"k{i % 9}", 0, -1, day(i + 70)) for i in range(0, 60, 4)]
    kind = "target string, key string, refs int, alive int, at timestamp_ntz"
    whole = spark.createDataFrame(refs + made, kind)
    ledger = Ledger(spark, f"{tmp_path}/l")
    assert ledger.read() is None
    for n in range(4):
        got = Ledger(spark, f"{tmp_path}/l").advance(spark.createDataFrame((made + refs)[n::4], kind))
    assert rows(got) == rows(apply_deltas(None, whole))
    assert rows(Ledger(spark, f"{tmp_path}/l").read()) == rows(got)


def test_reference_keys(spark):
    df = spark.createDataFrame([(" Ａ1.PNG\n",), ("　",), (None,), ("a b",)], "x string")
    assert [r["k"] for r in df.select(reference_key(F.col("x")).alias("k")).collect()] == ["a1.png", None, None, "a b"]


def test_ledger_is_order_free(spark):
    kind = "target string, key string, refs int, alive int, at timestamp_ntz"
    d = spark.createDataFrame([("t", "a", 1, 0, day(3)), ("t", "a", 0, -1, day(9)), ("t", "b", 1, 0, None)], kind)
    e = spark.createDataFrame([("t", "a", 0, 1, day(1)), ("t", "b", 0, 1, day(2)), ("t", None, 1, 0, day(1))], kind)
    one, two = apply_deltas(apply_deltas(None, d), e), apply_deltas(None, e.unionByName(d))
    assert rows(one) == rows(two) == [("t", "a", 1, 0, 1, day(1), day(9), day(3), day(3)), ("t", "b", 1, 1, 1, day(2), None, None, None)]
    assert rows(orphan_keys(one).select("key")) == [("a",)] and ever_orphans(one).collect() == []


def test_snapshots_by_deliveries_equal_one_run(spark, tmp_path):
    data = [(s, f"k{i}", str((i * s) % 3)) for s in range(1, 6) for i in range(40) if (i + s) % 4 and s != 4] + [(2, None, "n")]
    whole = rows(snapshot_changes(snap(spark, data)))
    assert {r[0] for r in whole} == {2, 3, 4, 5}
    at_once = rows(SnapshotStore(spark, f"{tmp_path}/one", per_bucket=7).advance(snap(spark, data)))
    assert at_once == whole
    steps, places = [], []
    for n in range(1, 6):
        store = SnapshotStore(spark, f"{tmp_path}/steps", per_bucket=7)
        steps += rows(store.advance(snap(spark, [r for r in data if r[0] == n]), last=n))
        places.append({r["key"]: (r["bucket"], r["pos"]) for r in store._read("dictionary").collect()})
    assert sorted(steps) == whole
    assert all(old.items() <= new.items() for old, new in zip(places, places[1:])) and len(set(places[-1].values())) == 40


def test_expand_pairs_over_blocks(spark):
    m = spark.createDataFrame([("hot", i) for i in range(30)] + [("x", 100), ("x", 101), (None, 5), ("y", None)], "k string, i int")
    p = spark.createDataFrame([("hot", "hot"), ("hot", "x"), ("x", "y"), ("x", "x")], "a string, b string")
    got = [(r["a"], r["b"]) for r in expand_pairs(p, m, "k", "i", block=4).collect()]
    assert len(got) == len({tuple(sorted(x)) for x in got}) == 30 * 29 // 2 + 60 + 1


def test_grouped_pairs_over_blocks(spark):
    df = spark.createDataFrame([("hot", (i,)) for i in range(60)] + [("x", (1,)), (None, (2,)), (None, (3,))], "k string, item struct<id:int>")
    got = [(r["a"]["id"], r["b"]["id"]) for r in grouped_pairs(df, "k", "item", block=7).collect()]
    assert len(got) == 60 * 59 // 2 == len({tuple(sorted(p)) for p in got})


def test_gates(spark):
    c = spark.createDataFrame([("p", 1), ("p", 3), ("p", 3), (None, 1)], "paper string, no int")
    assert rows(gates.completeness(c, "paper", "no")) == [("p", 2, 3, 1, "2")]
    b = spark.createDataFrame([("1", "A"), ("2", "B"), ("3", None)], "q string, v string")
    k = spark.createDataFrame([("1", "A"), ("2", "C"), ("3", None), ("4", "D")], "q string, v string")
    assert [r["state"] for r in gates.pairing(b, k, "q", "v").orderBy("q").collect()] == ["match", "mismatch", "match", "bank_missing"]
    m = spark.createDataFrame([("p", 4), ("p", 5), ("p", 5), ("p", 4)], "paper string, n int")
    assert rows(gates.mode_invariant(m, "paper", "n")) == [("p", 4, 4, 2)]
    s = gates.breaker(spark.createDataFrame([("a", True), ("a", True), ("b", True), ("b", False)], "g string, h boolean"), "g", F.col("h"))
    assert rows(s) == [("a", 2, 2, True), ("b", 2, 1, False)]
    l = spark.createDataFrame([("a", day(3), 1), ("a", day(0), 2), ("b", day(3), 3)], "k string, at timestamp_ntz, id int")
    r = spark.createDataFrame([("a", day(1), 10), ("a", day(3), 30), ("a", day(4), 40)], "k string, at timestamp_ntz, v int")
    assert {x["id"]: x["v"] for x in gates.asof_before(l, r, "k", "at", "v").collect()} == {1: 30, 2: None, 3: None}


def test_maintenance(spark, tmp_path):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    new = spark.createDataFrame([("b", 2), ("b", 3), ("c", None)], "k string, v int")
    assert rows(maintain.upsert(old, new, "k", ["v"])) == [("a", 1, "kept"), ("b", 3, "replaced"), ("c", None, "added")]
    assert rows(maintain.overlay([old, new], "k", "v")) == [("a", 1, 0), ("b", 3, 1)]
    t = spark.createDataFrame([("x\n\ny\n\nz",)], "t string")
    assert t.select(maintain.splice(F.col("t"), F.lit(2), F.lit("Q"))).first()[0] == "x\n\nQ\n\nz"
    assert t.select(maintain.splice(F.col("t"), F.lit(9), F.lit("Q"))).first()[0] == "x\n\ny\n\nz"
    path = str(tmp_path / "t")
    maintain.staged_write(old, path, ["k"])
    maintain.staged_write(old.where("k = 'a'"), path, ["k"])
    maintain.staged_write(new.where("v = 3"), path, ["k"])
    maintain.staged_write(old.where("k = 'a'"), path, ["k"])
    assert [spark.read.parquet(path + b).first()["k"] for b in ("", ".bak2", ".bak3")] == ["a", "a", "b"] and spark.read.parquet(path + ".bak1").count() == 2
    for bad in (old.limit(0), new.where("k = 'b'")):
        with pytest.raises(ValueError):
            maintain.staged_write(bad, path, ["k"])
    assert spark.read.parquet(path).count() == 1


LAWS = ["採石法", "水井法", "水井管理法", "渡船條例", "燈塔法"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("採石法第７條之2、採石法第 12 條、採石法第七條之二", [("採石法", "7-2"), ("採石法", "12"), ("採石法", "7-2")]),
        ("水井法律師的意見依水井管理法第 31 條第 2 項；燈塔法人登記後，渡船條例第 5 條", [("水井管理法", "31"), ("渡船條例", "5")]),
        ("燈塔法第 18-1 條與採石法第 40 條第 1 項", [("燈塔法", "18-1"), ("採石法", "40")]),
        ("燈塔法第十八之一條", [("燈塔法", "18-1")]),
        ("採石法第 22 條之 5 日內、水井法第一百零五條之三造", [("採石法", "22"), ("水井法", "105")]),
        ("依第 9 條（渡船條例）", [("渡船條例", "9")]),
        ("渡船條例與養蜂法第 3 條", []),
        ("採石法。第 5 條", []),
        (None, []),
        ("", []),
    ],
)
def test_citations(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(citations(F.col("t"), LAWS).alias("c")).first()["c"]
    assert [(c["law"], c["art"]) for c in got] == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("應於四十五日內，或 3萬元、1,200元", ["1200元", "30000元", "45日"]),
        ("民國 97 年 3 月 28 日修正，逾二個月", ["2月"]),
        ("一百二十天與２年", ["120日", "2年"]),
        ("", []),
        (None, []),
    ],
)
def test_key_numbers(text, want):
    assert key_numbers(text) == want


def test_numerals():
    assert key_numbers("3萬元", compat=True) == ["310000元"]
    assert normalize_numerals("四十日與２０日") == "40日與20日"
    assert [numeral_value(x) for x in ("二〇一", "十二", "三萬五千", "105")] == [201, 12, 35_000, 105]
    with pytest.raises(ValueError):
        numeral_value("甲")


def test_verdicts(spark):
    texts = ["採石法第 1 條：三十日內", "採石法第 1 條：四十日內", "採石法第 9 條", "舊法採石法第 9 條，現行法為第 1 條", "舊法採石法第 9 條", "燈塔法第 1 條"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").select("id", F.explode(citations(F.col("t"), LAWS)).alias("c")).select("id", "c.*")
    arts = spark.createDataFrame([("採石法", "1", "應於三十日內"), ("水井法", "1", "")], "law string, art string, t string").select("law", "art", key_numbers_col(F.col("t")).alias("numbers"))
    got = {r["id"]: (r["status"], r["note"]) for r in verdicts(df, arts).collect()}
    assert got == {0: ("ok", ""), 1: ("flag", "40日"), 2: ("fail", "article"), 3: ("historical", "article"), 4: ("fail", "article"), 5: ("fail", "law")}


def test_shared_folder(spark):
    df = session.stored(spark.range(3), "t")
    assert df.count() == 3 and session.clean(spark) >= 1 and session.clean(spark) == 0
    small, large = session.broadcast_below(spark.range(3), 3), session.broadcast_below(spark.range(4), 3)
    hint = lambda d: "Hint" in d._jdf.queryExecution().logical().toString()
    assert hint(small) and not hint(large)

    class Cluster:
        class conf:
            get = staticmethod(lambda name, default=None: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster)
