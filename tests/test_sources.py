import datetime as dt
import json

from pyspark.sql import functions as F

from stemforge.operators import geometry
from stemforge.sources import landing
from stemforge.streaming.deliveries import current, once, upsert_stream


def test_json_landing(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"qid": "1"}, {"qid": "2"}]))
    (tmp_path / "b.json").write_text(json.dumps({"items": [{"qid": "3"}]}))
    (tmp_path / "c.json").write_text(json.dumps({"qid": "4"}))
    (tmp_path / "d.json").write_text('{"qid": ')
    files = landing.json_files(spark, str(tmp_path))
    assert files.where("bad").count() == 1
    got = landing.json_items(files).select(F.try_variant_get("item", "$.qid", "string").alias("q")).collect()
    assert sorted(r["q"] for r in got) == ["1", "2", "3", "4"]


def test_tables_and_links(spark, tmp_path):
    (tmp_path / "t.md").write_text("| 1 | A | 2 | B/ |\n|---|---|---|---|\n| 3 | / |\nno table")
    pairs = landing.answer_pairs(landing.table_cells(landing.text_lines(spark, str(tmp_path))))
    assert sorted((r["no"], r["answer"]) for r in pairs.collect()) == [(1, "A"), (2, "B／"), (3, "／")]
    pages = spark.createDataFrame([("u", '<a href="/x/%E4%B8%80.pdf"><a href=\'y.pdf\'>')], "url string, html string")
    got = landing.links(pages, "https://h.example/d").collect()
    assert sorted((r["link"], r["name"]) for r in got) == [("https://h.example/d/y.pdf", "y.pdf"), ("https://h.example/x/%E4%B8%80.pdf", "一.pdf")]


def test_geometry(spark):
    spans = spark.createDataFrame([("d", 1, 50.0, 100.0, 90.0, 110.0, "1. 甲"), ("d", 1, 60.0, 120.0, 300.0, 130.0, "內文"), ("d", 1, 50.0, 200.0, 90.0, 210.0, "2. 乙")], "doc string, page int, x0 double, y0 double, x1 double, y1 double, text string")
    b = {r["no"]: (r["top"], r["bottom"]) for r in geometry.bands(spans).collect()}
    assert b == {1: (94.0, 194.0), 2: (194.0, 216.0)}
    d = spark.createDataFrame([("d", 1, 150.0, 190.0, "raster"), ("d", 1, 0.0, 800.0, "vector")], "doc string, page int, y0 double, y1 double, kind string")
    assert [(r["no"], r["score"]) for r in geometry.figures_in_bands(geometry.bands(spans), d).collect()] == [(1, 10)]
    h = spark.createDataFrame([("d", 1, 150.0, 7), ("d", 1, 10.0, 8)], "doc string, page int, y double, id int")
    assert {r["id"]: r["no"] for r in geometry.snap_above(h, geometry.anchors(spans)).collect()} == {7: 1, 8: None}


def test_streams(spark, tmp_path):
    src, t0 = str(tmp_path / "in"), dt.datetime(2024, 1, 1)
    spark.createDataFrame([("a", 1, t0), ("a", 1, t0), ("b", 2, t0)], "k string, v int, at timestamp").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("k string, v int, at timestamp").parquet(src)
    q = once(stream, "k", "at").writeStream.format("memory").queryName("once_out").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c1")).start()
    q.awaitTermination(120)
    assert spark.table("once_out").count() == 2
    q = upsert_stream(stream, str(tmp_path / "out"), "k", ["v"], str(tmp_path / "c2"))
    q.awaitTermination(120)
    out = str(tmp_path / "out")
    assert sorted(tuple(r) for r in current(spark, out, "k", ["v"]).select("k", "v").collect()) == [("a", 1), ("b", 2)]
    spark.createDataFrame([("b", 5)], "k string, v int").write.parquet(f"{out}/batch=7")
    assert sorted(tuple(r) for r in current(spark, out, "k", ["v"]).select("k", "v").collect()) == [("a", 1), ("b", 5)]


def test_binary_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF" + b"x" * 2000 + b"%%EOF\n")
    (tmp_path / "b.pdf").write_bytes(b"%PDF" + b"x" * 2000)
    (tmp_path / "c.pdf").write_bytes(b"<html>" + b"x" * 2000 + b"%%EOF")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    ok = {r["path"][-5:]: r["v"] for r in files.select("path", landing.valid_pdf(F.col("content")).alias("v")).collect()}
    assert ok == {"a.pdf": True, "b.pdf": False, "c.pdf": False}
    names = spark.createDataFrame([("a.pdf",), ("a.pdf",), ("zz",)], "name string")
    uris = {r["name"]: r["uri"] for r in landing.data_uris(files, names).collect()}
    assert uris["zz"] is None and uris["a.pdf"].startswith("data:image/png;base64,JVBERnh4") and "\r" not in uris["a.pdf"]
