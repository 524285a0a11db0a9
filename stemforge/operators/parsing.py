"""Parsing of papers, remarks, law pages and file names, as expressions over lines and windows over numbered pieces."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemforge.functions.numerals import article_number, ascii_width
from stemforge.functions.textcols import join_clean, roc_date, split_options

# Headers of a paper's parts and of groups, starts of questions, headings of law pages and what ends them.
PART_ONE = r"說\s*明\s*[:：︰]\s*第\s*1\s*題\s*至\s*第\s*(\d+)\s*題\s*為\s*單\s*選\s*題"
PART_TWO = r"第\s*貳\s*部\s*分"
SPAN = r"(\d+)\s*[-－–~至]\s*(\d+)"
GROUP = r"為\s*題\s*組"
NUMBER_START = r"(?m)^\s*(\d+)\s*[.．]\s*"
NEXT_PART = r"(?s)(?:為\s*題\s*組|第\s*貳\s*部\s*分|說\s*明\s*[:：︰]).*$"
LAW_HEADING = r"(?m)^[ \t　]*第[ \t　]*(\d+(?:[ \t　]*[-－之][ \t　]*\d+)?)[ \t　]*條(?=[ \t　]|$)"
LAW_FOOTERS = ["最新訊息", "本網站係提供法規之最新動態資訊", "法治宣導專區"]
CHAPTER_TAIL = r"(?:\n[ \t　]*第[ \t　]*[一二三四五六七八九十百]+[ \t　]*章[^\n]*)+\s*$"
FIRST_NO, LAST_NO = 1, 80
CASE_HEAD = r"情況題[^：:]{0,3}[：:]((?:(?!情況題)[\s\S]){1,600}?)第\s*(\d+)\s*題至第\s*(\d+)\s*題"
CASE_SPAN = 10

_int = lambda c: F.nullif(c, F.lit("")).try_cast("int")


def section_bounds(text: Column) -> Column:
    """STRUCT<single_max, part_two>: the last number of the first part, from its first header, and the line (from 0) of the second part's, or the number of lines."""
    lines = F.split(text, "\n")
    one = F.get(F.filter(lines, lambda x: x.rlike(PART_ONE)), 0)
    two = F.array_position(F.transform(lines, lambda x: x.rlike(PART_TWO)), True)
    return F.struct(_int(F.regexp_extract(one, PART_ONE, 1)).alias("single_max"), F.when(two > 0, two - 1).otherwise(F.size(lines)).cast("int").alias("part_two"))


def group_headers(text: Column) -> Column:
    """ARRAY<STRUCT<a, b, passage>> of the group headers, in order: ``a-b 為題組`` on one line, or on two in either order.

    The passage goes from the header to the group's first question, else to the next header.
    """
    one = F.regexp_replace(text, rf"(?m)^\s*{GROUP}\s*\n\s*{SPAN}\s*$", "$1-$2為題組")
    one = F.regexp_replace(one, rf"(?m)^\s*{SPAN}\s*\n\s*{GROUP}", "$1-$2為題組")
    head = rf"(?m)^\s*{SPAN}\s*{GROUP}"
    bodies = F.split(one, rf"(?m)^\s*\d+\s*[-－–~至]\s*\d+\s*{GROUP}")
    pairs = F.transform(F.regexp_extract_all(one, F.lit(head), F.lit(0)), lambda h, i: F.struct(F.regexp_extract(h, SPAN, 1).cast("int").alias("a"), F.regexp_extract(h, SPAN, 2).cast("int").alias("b"), F.get(bodies, i + 1).alias("body")))
    passage = lambda p: join_clean(F.regexp_replace(p["body"], F.concat(F.lit(r"(?ms)^\s*"), p["a"].cast("string"), F.lit(r"\s*[.．].*\z")), F.lit("")))
    return F.transform(pairs, lambda p: F.struct(p["a"].alias("a"), p["b"].alias("b"), passage(p).alias("passage")))


def group_members(texts: DataFrame, key: str, text: str, limit: int = CASE_SPAN) -> DataFrame:
    """(key, no, a, b, passage): the group of each number; the last header wins. Groups that run backwards or over more than ``limit`` numbers are left out."""
    g = texts.select(key, F.posexplode(group_headers(F.col(text))).alias("_k", "_g")).where((F.col("_g.a") <= F.col("_g.b")) & (F.col("_g.b") - F.col("_g.a") < limit))
    each = g.select(key, F.explode(F.sequence("_g.a", "_g.b")).alias("_no"), "_k", "_g")
    return each.groupBy(key, F.col("_no").alias("no")).agg(F.max_by("_g", "_k").alias("_g")).select(key, "no", "_g.a", "_g.b", "_g.passage")


def split_questions(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, no, segment): a text split at line-start numbers. A number counts at its first place and within FIRST_NO to LAST_NO; other numbers stay in the segment before, which ends at the next group or part header."""
    heads = F.regexp_extract_all(text, F.lit(NUMBER_START), F.lit(0))
    bodies = F.split(text, NUMBER_START.replace("(\\d+)", "\\d+"))
    pieces = F.transform(heads, lambda h, i: F.struct(h.alias("head"), F.get(bodies, i + 1).alias("body")))
    p = texts.select(key, F.posexplode(pieces).alias("pos", "p")).select(key, "pos", "p.*", _int(F.regexp_extract("p.head", r"(\d+)", 1)).alias("no"))
    p = p.withColumn("start", F.row_number().over(Window.partitionBy(key, "no").orderBy("pos")) == 1).withColumn("start", F.coalesce(F.col("start") & F.col("no").between(FIRST_NO, LAST_NO), F.lit(False)))
    p = p.withColumn("seg", F.sum(F.col("start").cast("int")).over(Window.partitionBy(key).orderBy("pos"))).where("seg > 0")  # one text
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "start", "head", "body"))), lambda x: F.when(x["start"], x["body"]).otherwise(F.concat(x["head"], x["body"]))), "")
    out = p.groupBy(key, "seg").agg(F.max(F.when(F.col("start"), F.col("no"))).alias("no"), whole.alias("segment"))
    return out.select(key, "no", F.regexp_replace("segment", NEXT_PART, "").alias("segment"))


def answer_remarks(text: Column) -> Column:
    """ARRAY<STRUCT<no, kind, accept>> of the remarks behind 備註: free (all get the mark), multi (several letters), changed (another letter) or other. Letters are folded."""
    part = F.regexp_replace(F.regexp_extract(text, r"(?s)備\s*註\s*[:：](.*)", 1), r"(?U)\s+", "")
    own = F.filter(F.split(part, "[，。]"), lambda x: x.rlike(r"^第\d+題(?!\d)"))
    tail = lambda x: F.regexp_replace(x, r"^第\d+題", "")
    letters = lambda x: F.array_sort(F.array_distinct(F.regexp_extract_all(F.translate(tail(x), "ＡＢＣＤＥ", "ABCDE"), F.lit("([A-E])"), F.lit(1))))
    kind = lambda x: F.when(x.rlike("一律給分|均給分|送分"), "free").when(F.size(letters(x)) > 1, "multi").when(x.rlike("更正|改為") & (F.size(letters(x)) == 1), "changed").otherwise("other")
    return F.transform(own, lambda x: F.struct(F.regexp_extract(x, r"^第(\d+)題", 1).cast("int").alias("no"), kind(x).alias("kind"), F.array_join(letters(x), "").alias("accept")))


def law_articles(text: Column) -> Column:
    """ARRAY<STRUCT<art, body>> of a law page: line-start headings; the last body ends at a page footer, and chapter headings at the end of a body are dropped."""
    page = ascii_width(text)
    heads = F.regexp_extract_all(page, F.lit(LAW_HEADING), F.lit(1))
    bodies = F.split(page, LAW_HEADING.replace("(\\d+(", "\\d+(").replace(")?)[ ", ")?[ "))
    body = lambda b: F.regexp_replace(F.regexp_replace(F.concat(F.lit("\n"), F.regexp_replace(b, "(?s)(?:" + "|".join(LAW_FOOTERS) + ").*$", "")), CHAPTER_TAIL, ""), r"(?U)\s+", " ")
    return F.transform(heads, lambda h, i: F.struct(article_number(h).alias("art"), F.trim(body(F.get(bodies, i + 1))).alias("body")))


def law_page_faults(text: Column, name: Column) -> Column:
    """What is wrong with a law page: the name isn't there, no heading, an empty body, a repeated heading, no date of amendment or publication. One ``law_articles`` is the input of three."""
    arts = law_articles(text)
    date = roc_date(F.regexp_extract(ascii_width(text), r"(?:修正|公布)日期\s*:\s*(民國[\s\d年月日]+)", 1))
    rules = (
        ("name", ~F.contains(F.regexp_replace(text, r"(?U)\s+", " "), name)), ("headings", F.size(arts) == 0), ("empty", F.exists(arts, lambda a: a["body"] == "")),
        ("repeated", F.size(F.array_distinct(F.transform(arts, lambda a: a["art"]))) < F.size(arts)), ("date", date.isNull()),
    )
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(k)) for k, bad in rules]))


def classify_file(name: Column, subjects: dict[str, str], exam: str = "學測") -> Column:
    """STRUCT<year, subject, kind, fault> of a file name: years 100 to 199 before the exam, one subject by its aliases, 試卷 or 答案.

    Sheets and rubrics are excluded (subject and kind null); several subjects that match at the same place are an error, not the first.
    """
    low = F.lower(F.regexp_replace(ascii_width(name), r"\s+", ""))
    year = _int(F.regexp_extract(low, rf"(1\d\d){exam}", 1))
    found = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(k.lower())), F.struct(F.lit(k).alias("alias"), F.lit(s).alias("subject"))) for k, s in subjects.items()]))
    longest = F.filter(found, lambda x: ~F.exists(found, lambda y: (F.length(y["alias"]) > F.length(x["alias"])) & F.contains(y["alias"], x["alias"])))
    names = F.array_distinct(F.transform(longest, lambda x: x["subject"]))
    sheet = low.rlike("答題卷|非選|評分|答案卡|特色")
    kind = F.when(sheet, None).when(F.contains(low, F.lit("答案")), "答案").when(low.rlike("試卷|試題"), "試卷")
    fault = F.when(year.isNull(), "year").when(F.size(names) == 0, "subject").when(F.size(names) > 1, "subjects").when(kind.isNull(), "kind").otherwise("")
    return F.struct(year.alias("year"), F.when(F.size(names) == 1, F.get(names, 0)).alias("subject"), kind.alias("kind"), fault.alias("fault"))


def first_hits(files: DataFrame, order: list[str], value: str) -> DataFrame:
    """(year, table MAP<subject, MAP<kind, value>>): of each year, subject and kind the first file in order."""
    one = files.groupBy("year", "subject", "kind").agg(F.min_by(value, F.struct(*order)).alias("v"))
    kinds = one.groupBy("year", "subject").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "v")))).alias("kinds"))
    return kinds.groupBy("year").agg(F.map_from_entries(F.collect_list(F.struct("subject", "kinds"))).alias("table"))


def shared_cases(text: Column) -> Column:
    """ARRAY<STRUCT<a, b, passage>> of case passages that several questions share: at most 600 characters, b not below a, at most CASE_SPAN questions."""
    found = F.regexp_extract_all(text, F.lit(CASE_HEAD), F.lit(0))
    part = lambda x, i: F.regexp_extract(x, CASE_HEAD, i)
    cases = F.transform(found, lambda x: F.struct(_int(part(x, 2)).alias("a"), _int(part(x, 3)).alias("b"), F.trim(part(x, 1)).alias("passage")))
    return F.filter(cases, lambda c: (c["b"] >= c["a"]) & (c["b"] - c["a"] < CASE_SPAN))


# --- lint of pieces


def own_figure(stem: Column, options: Column) -> Column:
    """A child question has a figure of its own: it says so, or all its options are empty."""
    values = F.coalesce(F.map_values(options), F.array().cast("array<string>"))
    empty = (F.size(values) > 0) & F.forall(values, lambda o: F.trim(F.coalesce(o, F.lit(""))) == "")
    return F.coalesce(stem.rlike("本題附圖|下圖|如圖|右圖|附圖"), F.lit(False)) | empty


def leaked_confidence(text: Column) -> Column:
    """Sentences that tell the writer's own confidence: an object, a level and the sentence's end together."""
    return F.filter(F.split(text, "(?<=[。！？])"), lambda s: s.rlike("(?:信心|把握|可信度)[^。！？]{0,6}(?:高|中|低|不足|有限)[^。！？]{0,4}[。！？]$"))


def option_collapse(options: Column) -> Column:
    """Signs that option texts lost their circled marks: ``within_dup`` one mark twice in an option, ``cross_iden`` two options with marks alike in order, ``marker_residual`` a private character at an option's head.

    Ordering questions (several options without repeated marks, all of the same marks, in at least two orders) are only looked at for the last.
    """
    values = F.transform(F.coalesce(F.map_values(options), F.array().cast("array<string>")), lambda o: F.coalesce(o, F.lit("")))
    marks = F.filter(F.transform(values, lambda o: F.regexp_extract_all(o, F.lit("([①-⑳])"), F.lit(1))), lambda m: F.size(m) > 0)
    plain = F.transform(F.filter(values, lambda o: o.rlike("[①-⑳]")), lambda o: F.regexp_replace(o, r"(?U)[\s僅]+", ""))
    once = F.forall(marks, lambda m: F.size(F.array_distinct(m)) == F.size(m))
    ordering = (F.size(marks) >= 2) & once & (F.size(F.array_distinct(F.transform(marks, lambda m: F.array_sort(m)))) == 1) & (F.size(F.array_distinct(marks)) >= 2)
    rules = (("within_dup", ~once & ~ordering), ("cross_iden", (F.size(F.array_distinct(plain)) < F.size(plain)) & ~ordering), ("marker_residual", F.exists(values, lambda o: o.rlike("^[\ue000-\uf8ff]"))))
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules]))


def bleeds(options: Column, following: Column, least: int = 20) -> Column:
    """Letters of options that contain the next question's beginning, of at least ``least`` characters."""
    start = F.substring(F.regexp_replace(following, r"(?U)\s+", ""), 1, least)
    hit = lambda o: (F.length(start) >= least) & F.contains(F.regexp_replace(o, r"(?U)\s+", ""), start)
    return F.array_sort(F.map_keys(F.map_filter(options, lambda k, o: F.coalesce(hit(o), F.lit(False)))))


def orphan_units(text: Column) -> Column:
    """Units without their value (得 mg。)."""
    return text.rlike(r"得\s*(?:mg|kg|mL|ml|cm|mm|km|m|g|L|s|N|J|W|V|A|Pa|mol)\s*[．.。·/，,]")


def cut_furniture(option: Column) -> Column:
    """An option up to an explicit mark of page furniture; never cut at a mere line end."""
    return F.regexp_replace(option, r"(?s)\s*(?:請翻頁繼續作答|背面尚有試題|第\s*\d+\s*頁\s*共\s*\d+\s*頁|請勿攜出).*$", "")


# --- fallbacks and repairs by position and by pools of characters


def items_by_position(spans: DataFrame, least_options: int = 4, least_han: int = 8) -> DataFrame:
    """(doc, no, stem, options) of spans (doc, page, x0, y0, text) in reading order: an item begins at a span ``no. text`` of more than six characters and ends at the next.

    options is null with fewer than ``least_options`` of them, stem is null with fewer than ``least_han`` ideographs: then the coordinates can't replace the text.
    """
    start = F.col("text").rlike(r"^\s*\d{1,3}\s*[.．]\s*\S") & (F.length("text") > 6)
    w = Window.partitionBy("doc").orderBy("page", "y0", "x0")  # one paper
    rows = spans.withColumn("_start", start).withColumn("_item", F.sum(F.col("_start").cast("int")).over(w)).withColumn("_pos", F.row_number().over(w)).where("_item > 0")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "text"))), lambda x: x["text"]), " ")
    items = rows.groupBy("doc", "_item").agg(text.alias("t")).select("doc", F.regexp_extract("t", r"^\s*(\d+)", 1).cast("int").alias("no"), F.regexp_replace("t", r"^\s*\d+\s*[.．]\s*", "").alias("t"))
    stem, options = F.trim(F.regexp_replace("t", r"(?s)\([A-E]\).*$", "")), split_options(F.col("t"))
    return items.select("doc", "no", F.when(F.regexp_count(stem, F.lit("[一-鿿]")) >= least_han, stem).alias("stem"), F.when(F.size(options) >= least_options, options).alias("options"))


def unrotated(tail: Column, numbers: Column, source: Column) -> Column:
    """Numbers of options that moved up by one, so that the stem's tail has the first one's: moved back, if together they are just the numbers of the source; else as they are."""
    back = F.concat(F.array(tail), F.slice(numbers, 1, F.greatest(F.size(numbers) - 1, F.lit(0))))
    moved = (F.element_at(numbers, -1) == "") & (F.array_sort(back) == F.array_sort(source))
    return F.when(F.coalesce(moved, F.lit(False)), back).otherwise(numbers)


def cut_pool(text: str | None, pool: str | None) -> str | None:
    """The text without the longest end whose characters are all in the pool, each as often as it is there; unchanged unless the pool is used up."""
    if not text or not pool:
        return text
    left, at = Counter(pool), len(text)
    while at and left[text[at - 1]] > 0:
        at -= 1
        left[text[at]] -= 1
    return text[:at] if len(text) - at == len(pool) else text


def cut_pool_col(text: Column, pool: Column) -> Column:
    return F.pandas_udf(lambda t, p: pd.Series([cut_pool(a, b) for a, b in zip(t, p)], dtype=object), "string")(text, pool)


def repair_glyphs(texts: DataFrame, glyphs: DataFrame) -> DataFrame:
    """texts (id, paper, font, text) with private characters replaced by glyphs (paper, font, seen, true), and how many stay unknown.

    A character means something only within its paper and font; two meanings there are an error. A paper's glyphs are a small map.
    """
    one = glyphs.groupBy("paper", "font", "seen").agg(F.when(F.countDistinct("true") > 1, F.raise_error(F.concat_ws(" ", F.lit("two meanings:"), "paper", "font", "seen")).cast("string")).otherwise(F.min("true")).alias("true"))
    maps = one.groupBy("paper", "font").agg(F.map_from_entries(F.collect_list(F.struct("seen", "true"))).alias("_m"))
    fixed = F.array_join(F.transform(F.split("text", ""), lambda c: F.coalesce(F.element_at("_m", c), c)), "")
    j = texts.join(maps, ["paper", "font"], "left").withColumn("text", F.when(F.col("_m").isNull(), F.col("text")).otherwise(fixed))
    return j.select("id", "text", F.regexp_count("text", F.lit("[\ue000-\uf8ff]")).alias("unknown"))
