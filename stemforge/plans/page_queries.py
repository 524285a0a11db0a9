"""Queries of boxes on pages. No table holds spans, so the lines of documents are laid on pages of 40 lines each, 18 points
apart; every seventh line is followed by a drawing, and lines that begin with a number are items."""

from __future__ import annotations

from pyspark.sql import functions as F

from stemforge.operators import geometry as geo
from stemforge.plans.dual import duck_sql
from stemforge.plans.question_queries import Tables

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[f.__name__] = duck_sql(sql)
        return f

    return register


def spans(t):
    lines = t.documents.where("text is not null").select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("i", "text")).where("trim(text) <> ''")
    x0, y0 = F.when(F.col("text").rlike("^[ 　]"), 110.0).otherwise(50.0), 60.0 + 18.0 * (F.col("i") % 40)
    return lines.select("doc", F.floor(F.col("i") / 40).cast("int").alias("page"), x0.alias("x0"), y0.alias("y0"), (x0 + 10.0 * F.length("text")).alias("x1"), (y0 + 12.0).alias("y1"), "text", "i")


def drawings(t):
    """A drawing behind every seventh line, a vector one behind the odd ones; it may reach beyond the next line."""
    d = spans(t).where("i % 7 = 3")
    return d.select("doc", "page", "x0", (F.col("y0") + 6.0).alias("y0"), (F.col("x0") + 200.0).alias("x1"), (F.col("y0") + 40.0).alias("y1"), F.when(F.col("i") % 2 == 1, "vector").otherwise("raster").alias("kind"), F.col("i").alias("id"))


_SPANS = r"""s AS (SELECT doc, CAST(floor(i / 40) AS INT) AS page, x0, 60.0::DOUBLE + 18 * (i % 40) AS y0, x0 + 10 * length(text) AS x1, 72.0::DOUBLE + 18 * (i % 40) AS y1, text, i FROM (SELECT *, CASE WHEN regexp_matches(text, '^[ 　]') THEN 110.0::DOUBLE ELSE 50.0::DOUBLE END AS x0 FROM (SELECT doc_id AS doc, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents WHERE text IS NOT NULL) a WHERE trim(text, ' ') <> '') b),
d AS (SELECT doc, page, x0, y0 + 6 AS y0, x0 + 200 AS x1, y0 + 40 AS y1, CASE WHEN i % 2 = 1 THEN 'vector' ELSE 'raster' END AS kind, i AS id FROM s WHERE i % 7 = 3),
a AS (SELECT doc, page, TRY_CAST(regexp_extract(text, '^\s*(\d{1,3})[.．]', 1) AS INT) AS no, y0 FROM s WHERE x0 < 92 AND regexp_matches(text, '^\s*\d{1,3}[.．]')),
t AS (SELECT doc, page, max(y1) AS text_bottom FROM s WHERE y1 < 812 GROUP BY 1, 2),
bands AS (SELECT a.doc, a.page, a.no, a.y0 - 6 AS top, coalesce(lead(a.y0) OVER (PARTITION BY a.doc, a.page ORDER BY a.y0, a.no) - 6, text_bottom + 6) AS bottom FROM a JOIN t ON a.doc = t.doc AND a.page = t.page)"""
_W = "WITH " + _SPANS


@query(_W + " SELECT doc, page, count(*) AS spans, CAST(sum(length(text)) AS BIGINT) AS chars, round(max(x1), 3) AS right_edge FROM s GROUP BY 1, 2")
def geo01_char_boxes(t):
    b = geo.char_boxes(spans(t).select("doc", "page", "x0", "y0", "x1", "text"))
    return b.groupBy("doc", "page").agg(F.countDistinct("y0").alias("spans"), F.count("*").alias("chars"), F.round(F.max("x1"), 3).alias("right_edge"))


@query(_W + " SELECT doc, page, no, y0 FROM a")
def geo02_anchors(t):
    return geo.anchors(spans(t))


@query(_W + " SELECT doc, page, min(y0) AS y FROM s WHERE x0 < 92 AND regexp_matches(text, '^\\s*(?:第[一二三四五六七八九十壹貳參]部分|[一二三四五六七八九十]+、)') GROUP BY 1, 2")
def geo03_heading_limits(t):
    return geo.heading_limits(spans(t))


_HEADS = "(SELECT *, concat(i % 50 + 1, CASE i % 3 WHEN 0 THEN '-' WHEN 1 THEN ' 至 ' ELSE '～' END, i % 50 + 3, CASE i % 2 WHEN 0 THEN '題為題組' ELSE ' 為題組' END) AS head FROM s)"


@query(_W + " SELECT doc, page, y0 AS y, CAST(i % 50 + 1 AS INT) AS a, CAST(i % 50 + 3 AS INT) AS b FROM s WHERE i % 3 <> 2")
def geo04_group_heads(t):
    """Heads written over each line with the separators by turns; the third is none of them."""
    sep = F.element_at(F.array(F.lit("-"), F.lit(" 至 "), F.lit("/")), (F.col("i") % 3 + 1).cast("int"))
    head = F.concat((F.col("i") % 50 + 1).cast("string"), sep, (F.col("i") % 50 + 3).cast("string"), F.when(F.col("i") % 2 == 0, "題為題組").otherwise(" 為題組"))
    return geo.group_heads(spans(t).withColumn("text", head))


@query(_W + " SELECT b.doc, b.page, b.no, CAST(sum(CASE WHEN kind = 'raster' THEN 10 ELSE 1 END) AS BIGINT) AS score, greatest(max(bottom), max(least(y1, bottom + 24))) AS bottom, sum(CASE WHEN kind = 'raster' THEN 10 ELSE 1 END) >= 10 AS figure FROM bands b JOIN d ON b.doc = d.doc AND b.page = d.page AND d.y0 < b.bottom AND d.y1 > b.top GROUP BY 1, 2, 3")
def geo06_figures_in_bands(t):
    """Scores of the bands between items, and how far a figure extends them (GEO-5, JOIN-19)."""
    f = geo.figures_in_bands(geo.bands(spans(t)), drawings(t))
    return f.select("*", (F.col("score") >= geo.FIGURE_SCORE).alias("figure"))


@query(_W + " SELECT doc, page, text_bottom FROM t")
def geo07_page_bottoms(t):
    return spans(t).where(F.col("y1") < 842.0 - geo.FOOTER).groupBy("doc", "page").agg(F.max("y1").alias("text_bottom"))


@query(r"SELECT b.row_id, count(*) AS files, min(f.filename) AS filename FROM bank b JOIN (SELECT DISTINCT filename, CAST(regexp_extract(filename, '^[A-Z](\d+)_(\d{6})_(?:g(\d+)_(\d+)|q(\d+))', 1) AS INT) AS year, regexp_extract(filename, '^[A-Z](\d+)_(\d{6})_', 2) AS round, CAST(coalesce(nullif(regexp_extract(filename, '_g(\d+)_(\d+)', 1), ''), nullif(regexp_extract(filename, '_q(\d+)', 1), '')) AS INT) AS a, CAST(coalesce(nullif(regexp_extract(filename, '_g(\d+)_(\d+)', 2), ''), nullif(regexp_extract(filename, '_q(\d+)', 1), '')) AS INT) AS b FROM figure_files WHERE regexp_matches(filename, '^[A-Z]\d+_\d{6}_(g\d+_\d+|q\d+)')) f ON f.year = b.year AND f.round = regexp_extract(b.qid, '_(\d{6})_', 1) AND b.no BETWEEN f.a AND f.b GROUP BY b.row_id")
def geo08_group_figures(t):
    """Figures by the convention of their names, given to every question of the group."""
    f = t.figure_files.select("filename").distinct().select("filename", geo.figure_name_parts(F.col("filename")).alias("p")).select("filename", "p.*").where("year is not null and b - a between 0 and 20")
    each = f.select("filename", "year", "round", F.explode(F.sequence("a", "b")).alias("no"))
    b = t.bank.select("row_id", "year", F.regexp_extract("qid", r"_(\d{6})_", 1).alias("round"), "no")
    return b.join(each, ["year", "round", "no"]).groupBy("row_id").agg(F.count("*").alias("files"), F.min("filename").alias("filename"))


@query(_W + " SELECT f.doc, f.page, f.id AS figure, count(*) FILTER (c.x0 >= f.x0 AND c.x1 <= f.x1 AND c.y0 >= f.y0 AND c.y1 <= f.y1) AS inside, count(*) FILTER (NOT (c.x0 >= f.x0 AND c.x1 <= f.x1 AND c.y0 >= f.y0 AND c.y1 <= f.y1)) AS cut FROM d f JOIN s c ON f.doc = c.doc AND f.page = c.page AND c.x0 < f.x1 AND c.x1 > f.x0 AND c.y0 < f.y1 AND c.y1 > f.y0 GROUP BY 1, 2, 3")
def geo09_captions(t):
    captions = spans(t).select("doc", "page", F.col("i").alias("id"), "x0", "y0", "x1", "y1")
    return geo.captions_in(drawings(t).select("doc", "page", "id", "x0", "y0", "x1", "y1"), captions)


@query(_W + ", h AS (SELECT doc, page, id, y0 + 2 AS y FROM d) SELECT h.doc, h.page, h.id, (SELECT arg_max(a.no, (a.y0, a.no)) FROM a WHERE a.doc = h.doc AND a.page = h.page AND a.y0 <= h.y) AS no FROM h")
def join17_snap_to_item(t):
    """The item that each drawing belongs to: the last one above."""
    return geo.snap_above(drawings(t).select("doc", "page", F.col("y0").alias("y"), "id"), geo.anchors(spans(t)))


@query(_W + " SELECT s.doc, s.page, s.i, (SELECT min(n.y0) FROM s n WHERE n.doc = s.doc AND n.page = s.page AND floor(n.x0 / 40) = floor(s.x0 / 40) AND n.y0 > s.y0 + 2) AS next_y FROM s")
def join18_next_below(t):
    return geo.next_below(spans(t).select("doc", "page", "x0", "y0", F.col("i").alias("no"))).select("doc", "page", F.col("no").alias("i"), "next_y")


@query(_W + " SELECT doc, i, CAST(row_number() OVER (PARTITION BY doc ORDER BY page, y0, x0) AS INT) AS pos FROM s")
def srt01_reading_order(t):
    return geo.reading_order(spans(t)).select("doc", "i", "pos")


@query(_W + ", m AS (SELECT doc, page, i AS id, (y0 + y1) / 2 AS cy FROM (SELECT doc, page, i, y0 + 3 * (i % 4) AS y0, y1 + 3 * (i % 4) AS y1 FROM s WHERE i % 5 = 4) x), l AS (SELECT doc, page, i AS line, (y0 + y1) / 2 AS mid FROM s WHERE i % 5 <> 4), n AS (SELECT m.*, (SELECT arg_min({'line': line, 'mid': mid}, (abs(mid - cy), mid)) FROM l WHERE l.doc = m.doc AND l.page = m.page) AS b FROM m) SELECT doc, page, id, b.line AS line, CASE WHEN b IS NULL THEN NULL WHEN b.mid - cy > 4 THEN 'sup' WHEN b.mid - cy < -4 THEN 'sub' ELSE 'base' END AS place FROM n")
def par15_lines_of_small_spans(t):
    """Every fifth line, shifted, as a small span: the nearest other line and its place there (PAR-15, PAR-16)."""
    s = spans(t).withColumnRenamed("i", "id")
    small = s.where("id % 5 = 4").withColumns({"y0": F.col("y0") + 3 * (F.col("id") % 4), "y1": F.col("y1") + 3 * (F.col("id") % 4)})
    return geo.to_lines(small, s.where("id % 5 <> 4"))


@query(_W + " SELECT doc, page, count(*) AS lines, count(*) FILTER (regexp_matches(text, '^\\s*\\d{1,3}\\s*[.．]') OR y1 <= 90 OR y0 >= 700) AS kept FROM s GROUP BY 1, 2")
def drv29_whitened_lines(t):
    return geo.kept_when_whitened(spans(t), 90.0, 700.0).groupBy("doc", "page").agg(F.count("*").alias("lines"), F.count_if("kept").alias("kept"))
