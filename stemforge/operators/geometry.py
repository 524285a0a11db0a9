"""Boxes on pages: anchors, bands between anchors, overlaps and nearest lines, all by equality on the page and windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Margins and limits of a page, in points; scores of a band with a figure; headings of sections and heads of groups.
LEFT, FOOTER, PAD, SLACK, COLUMN = 92.0, 30.0, 6.0, 24.0, 40.0
FIGURE_SCORE = 10
SECTION_HEADING = r"^\s*(?:第[一二三四五六七八九十壹貳參]部分|[一二三四五六七八九十]+、)"
GROUP_HEAD = r"^\s*(\d+)\s*[-－–~至]\s*(\d+)\s*(?:題)?\s*為題組"


def anchors(spans: DataFrame) -> DataFrame:
    """(doc, page, no, y0): question numbers at the left margin of spans (doc, page, x0, y0, x1, y1, text)."""
    no = F.regexp_extract("text", r"^\s*(\d{1,3})[.．]", 1)
    return spans.where((F.col("x0") < LEFT) & (no != "")).select("doc", "page", no.cast("int").alias("no"), "y0")


def bands(spans: DataFrame, page_height: float = 842.0) -> DataFrame:
    """(doc, page, no, top, bottom): from each anchor to the next one on the page, or the page's text bottom."""
    w = Window.partitionBy("doc", "page").orderBy("y0", "no")
    bottom = spans.where(F.col("y1") < page_height - FOOTER).groupBy("doc", "page").agg(F.max("y1").alias("text_bottom"))
    a = anchors(spans).withColumn("nxt", F.lead("y0").over(w))
    return a.join(bottom, ["doc", "page"]).select("doc", "page", "no", (F.col("y0") - PAD).alias("top"), F.coalesce(F.col("nxt") - PAD, F.col("text_bottom") + PAD).alias("bottom"))


def figures_in_bands(band: DataFrame, drawings: DataFrame, page_height: float = 842.0) -> DataFrame:
    """(doc, page, no, score, bottom): raster images weigh 10 and vector drawings 1; full-frame ones don't count; a drawing that starts in a band may extend it by SLACK."""
    d = drawings.where((F.col("y1") - F.col("y0")) < 0.85 * page_height).select("doc", "page", F.col("y0").alias("dy0"), F.col("y1").alias("dy1"), "kind")
    j = band.join(d, ["doc", "page"]).where((F.col("dy0") < F.col("bottom")) & (F.col("dy1") > F.col("top")))
    score = F.sum(F.when(F.col("kind") == "raster", 10).otherwise(1))
    return j.groupBy("doc", "page", "no").agg(score.alias("score"), F.greatest(F.max("bottom"), F.max(F.least(F.col("dy1"), F.col("bottom") + SLACK))).alias("bottom"))


def snap_above(hints: DataFrame, marks: DataFrame, tolerance: float = 2.0) -> DataFrame:
    """hints (doc, page, y, id) with the number of the lowest anchor at or above y + tolerance: one ordered window over both sides."""
    both = hints.select("doc", "page", (F.col("y") + tolerance).alias("y"), "id", F.lit(None).cast("int").alias("no")).unionByName(marks.select("doc", "page", F.col("y0").alias("y"), F.lit(None).cast(dict(hints.dtypes)["id"]).alias("id"), "no"))
    w = Window.partitionBy("doc", "page").orderBy("y", F.col("no").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("no", F.last("no", True).over(w)).where("id is not null").select("doc", "page", "id", "no")


def reading_order(spans: DataFrame) -> DataFrame:
    return spans.withColumn("pos", F.row_number().over(Window.partitionBy("doc").orderBy("page", "y0", "x0")))


def char_boxes(spans: DataFrame) -> DataFrame:
    """(doc, page, y0, pos, ch, x0, x1): each character of a span with its share of the span's width."""
    step = (F.col("x1") - F.col("sx")) / F.length("text")
    rows = spans.where("length(text) > 0").select("doc", "page", "y0", F.col("x0").alias("sx"), "x1", "text", F.posexplode(F.split("text", "")).alias("pos", "ch")).where("ch <> ''")
    return rows.select("doc", "page", "y0", "pos", "ch", (F.col("sx") + step * F.col("pos")).alias("x0"), (F.col("sx") + step * (F.col("pos") + 1)).alias("x1"))


def heading_limits(spans: DataFrame) -> DataFrame:
    """(doc, page, y): the first section heading at the left margin of each page."""
    return spans.where((F.col("x0") < LEFT) & F.col("text").rlike(SECTION_HEADING)).groupBy("doc", "page").agg(F.min("y0").alias("y"))


def group_heads(spans: DataFrame) -> DataFrame:
    """(doc, page, y, a, b): heads of groups, with any separator."""
    part = lambda i: F.regexp_extract("text", GROUP_HEAD, i).cast("int")
    return spans.where(F.col("text").rlike(GROUP_HEAD)).select("doc", "page", F.col("y0").alias("y"), part(1).alias("a"), part(2).alias("b"))


def next_below(items: DataFrame, tolerance: float = 2.0) -> DataFrame:
    """items (doc, page, x0, y0, no) with the top of the next item of the same column (COLUMN points wide) that begins more than ``tolerance`` lower."""
    col, at = F.floor(F.col("x0") / COLUMN), F.round(F.col("y0") * 1000).cast("bigint")
    tops = items.groupBy("doc", "page", col.alias("_c"), at.alias("_y")).agg(F.min("y0").alias("y"))
    w = Window.partitionBy("doc", "page", "_c").orderBy("_y").rangeBetween(round(tolerance * 1000) + 1, Window.unboundedFollowing)
    nxt = tops.select("doc", "page", "_c", "_y", F.min("y").over(w).alias("next_y"))
    return items.withColumn("_c", col).withColumn("_y", at).join(nxt, ["doc", "page", "_c", "_y"]).select(*items.columns, "next_y")


def captions_in(figures: DataFrame, captions: DataFrame) -> DataFrame:
    """(doc, page, figure, inside, cut): captions whose box lies within a figure's, and those that it only cuts. Boxes meet by the bands of 50 points they touch."""
    band = lambda df: df.withColumn("_b", F.explode(F.sequence(F.floor(F.col("y0") / 50), F.floor(F.col("y1") / 50))))
    c = band(captions.select("doc", "page", F.col("id").alias("cid"), F.col("x0").alias("cx0"), F.col("y0"), F.col("x1").alias("cx1"), F.col("y1")).withColumns({"cy0": F.col("y0"), "cy1": F.col("y1")})).drop("y0", "y1")
    j = band(figures).join(c, ["doc", "page", "_b"]).where("cx0 < x1 and cx1 > x0 and cy0 < y1 and cy1 > y0").dropDuplicates(["doc", "page", "id", "cid"])
    inside = (F.col("cx0") >= F.col("x0")) & (F.col("cx1") <= F.col("x1")) & (F.col("cy0") >= F.col("y0")) & (F.col("cy1") <= F.col("y1"))
    return j.groupBy("doc", "page", F.col("id").alias("figure")).agg(F.count_if(inside).alias("inside"), F.count_if(~inside).alias("cut"))


def figure_name_parts(name: Column) -> Column:
    """STRUCT<year, round, a, b> of a figure's name: G94_100176_g14_15.png of a group, G94_100176_q36.png of a question."""
    pattern = r"^[A-Z](\d+)_(\d{6})_(?:g(\d+)_(\d+)|q(\d+))"
    n = lambda i: F.nullif(F.regexp_extract(name, pattern, i), F.lit("")).cast("int")
    return F.struct(n(1).alias("year"), F.regexp_extract(name, pattern, 2).alias("round"), F.coalesce(n(3), n(5)).alias("a"), F.coalesce(n(4), n(5)).alias("b"))


def to_lines(small: DataFrame, lines: DataFrame) -> DataFrame:
    """small (doc, page, id, y0, y1, ...) with the line (line, mid) whose vertical centre is nearest, and its place: above the centre ``sup``, below ``sub``, else ``base``.

    The nearest line is the last at or above or the first below, so one ordered window over both sides does. A third of a line's height is base.
    """
    mid = (F.col("y0") + F.col("y1")) / 2
    l = lines.select("doc", "page", mid.alias("at"), F.struct(mid.alias("mid"), F.col("id").alias("line"), (F.col("y1") - F.col("y0")).alias("h")).alias("l"), F.lit(None).cast(dict(small.dtypes)["id"]).alias("id"))
    both = l.unionByName(small.select("doc", "page", mid.alias("at"), F.lit(None).cast(dict(l.dtypes)["l"]).alias("l"), "id"))
    w = Window.partitionBy("doc", "page")
    up = F.last("l", True).over(w.orderBy("at", F.col("l").isNull()).rowsBetween(Window.unboundedPreceding, 0))
    down = F.last("l", True).over(w.orderBy(F.desc("at"), F.col("l").isNull()).rowsBetween(Window.unboundedPreceding, 0))
    near = both.select("doc", "page", "id", "at", up.alias("u"), down.alias("d")).where("id is not null")
    best = F.when(F.col("d").isNull() | (F.col("at") - F.col("u.mid") <= F.col("d.mid") - F.col("at")), F.col("u")).otherwise(F.col("d"))
    near = near.select("doc", "page", "id", "at", best.alias("b"))
    off = F.col("b.mid") - F.col("at")
    place = F.when(off > F.col("b.h") / 3, "sup").when(off < -F.col("b.h") / 3, "sub").otherwise("base")
    return near.select("doc", "page", "id", F.col("b.line").alias("line"), F.when(F.col("b").isNotNull(), place).alias("place"))


def kept_when_whitened(spans: DataFrame, top: float, bottom: float) -> DataFrame:
    """spans with ``kept``: lines that begin with a question's number, and lines wholly outside the content box; the rest is erased."""
    number = F.col("text").rlike(r"^\s*\d{1,3}\s*[.．]")
    return spans.withColumn("kept", number | (F.col("y1") <= top) | (F.col("y0") >= bottom))
