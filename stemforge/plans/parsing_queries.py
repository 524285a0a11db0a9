"""Queries of parsing and parity. No table holds raw papers, so papers, remarks and file names are written from the bank's
columns and parsed back; the SQL takes the columns themselves."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stemforge.functions import textcols as tx
from stemforge.operators import gates, parity, parsing
from stemforge.plans.dual import duck_sql
from stemforge.plans.question_queries import Tables
from stemforge.plans.statements import paper, squeeze
from stemforge.sources import landing

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[f.__name__] = duck_sql(sql)
        return f

    return register


def _one_line(c):
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)[\s\d.．]+", "")


_PLAIN = "regexp_replace(coalesce({0}, ''), '[\\s\\p{{Z}}\\x{{85}}\\x{{b}}\\p{{Nd}}.．]+', '', 'g')"


@query(f"SELECT {paper()} AS paper, CAST(max(no) AS INT) AS single_max, CAST(1 AS INT) AS part_two FROM <q> q WHERE no IS NOT NULL AND {paper()} <> '' GROUP BY 1")
def par01_section_bounds(t):
    p = t.q("no").where("no is not null").groupBy(gates.paper_of(F.col("qid")).alias("paper")).agg(F.max("no").alias("n")).where("paper <> ''")
    text = F.concat(F.lit("說明： 第 1 題至第 "), F.col("n").cast("string"), F.lit(" 題為單選題\n第 貳 部 分\n說明：第1題至第1題為單選題\n第貳部分"))
    return p.select("paper", parsing.section_bounds(text).alias("b")).select("paper", "b.*")


_GROUPS = f"SELECT {paper()} AS paper, group_id, min(no) AS a, max(no) AS b, {_PLAIN.format('min(passage)')} AS passage FROM <q> q WHERE group_id IS NOT NULL AND no IS NOT NULL GROUP BY 1, 2"


@query(f"SELECT group_id, CAST(no AS INT) AS no, CAST(a AS INT) AS a, CAST(b AS INT) AS b, passage FROM (SELECT group_id, a, b, passage, unnest(range(a, b + 1)) AS no FROM ({_GROUPS}) g WHERE b - a < 10) x")
def par02_group_members(t):
    g = t.q("group_id", "no", "passage").where("group_id is not null and no is not null").groupBy(gates.paper_of(F.col("qid")).alias("paper"), "group_id").agg(F.min("no").alias("a"), F.max("no").alias("b"), _one_line(F.min("passage")).alias("passage"))
    span = F.concat_ws("-", F.col("a").cast("string"), F.col("b").cast("string"))
    head = F.when(F.col("a") % 3 == 0, F.concat(span, F.lit(" 為題組\n"))).when(F.col("a") % 3 == 1, F.concat(F.lit("為題組\n"), span, F.lit("\n"))).otherwise(F.concat(span, F.lit("\n為 題 組\n")))
    text = F.concat(head, "passage", F.lit("\n"), F.col("a").cast("string"), F.lit(". 題幹\n"))
    return parsing.group_members(g.select("group_id", text.alias("text")), "group_id", "text").where("passage is not null")


_STARTS = "WITH l AS (SELECT doc_id, i, line, TRY_CAST(regexp_extract(line, '^\\s*(\\d+)\\s*[.．]', 1) AS INT) AS no FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL) x), f AS (SELECT *, no BETWEEN 1 AND 80 AND row_number() OVER (PARTITION BY doc_id, no ORDER BY i) = 1 AS start FROM l), s AS (SELECT *, sum(CASE WHEN start THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS seg FROM f)"


@query(_STARTS + " SELECT doc_id, CAST(max(CASE WHEN start THEN no END) AS INT) AS no, CAST(length(" + squeeze("regexp_replace(string_agg(CASE WHEN start THEN regexp_replace(line, '^\\s*\\d+\\s*[.．]', '') ELSE line END, chr(10) ORDER BY i), '(?s)(?:為\\s*題\\s*組|第\\s*貳\\s*部\\s*分|說\\s*明\\s*[:：︰]).*$', '')") + ") AS INT) AS chars FROM s WHERE seg > 0 GROUP BY doc_id, seg")
def par04_questions(t):
    """Documents split at line-start numbers."""
    q = parsing.split_questions(t.documents.where("text is not null").select("doc_id", "text"), "doc_id", "text")
    return q.select("doc_id", "no", F.length(tx.squeeze(F.col("segment"))).alias("chars"))


@query("SELECT row_id, array_to_string(map_keys(options), '') AS letters, CAST(list_sum(list_transform(map_values(options), lambda o: length(regexp_replace(coalesce(o, ''), '[\\s\\p{Z}\\x{85}\\x{b}\\p{Nd}.．()]+', '', 'g')))) AS BIGINT) AS chars FROM bank WHERE options IS NOT NULL AND cardinality(options) > 0 AND len(list_filter(map_keys(options), lambda k: k NOT IN ('A', 'B', 'C', 'D', 'E'))) = 0")
def par05_options(t):
    """Options written behind a stem and split again; a repeated letter behind them doesn't count."""
    b = t.bank.where("size(options) > 0").where(F.forall(F.map_keys("options"), lambda k: k.isin(*"ABCDE")))
    plain = lambda o: F.regexp_replace(F.coalesce(o, F.lit("")), r"(?U)[\s\d.．()]+", "")
    text = F.concat(F.lit("題幹"), F.array_join(F.transform(F.map_entries("options"), lambda e: F.concat(F.lit("("), e["key"], F.lit(") "), plain(e["value"]))), " "), F.lit(" (A) 重複 12. 下一題"))
    o = b.select("row_id", tx.split_options(text).alias("o"))
    return o.select("row_id", F.array_join(F.map_keys("o"), "").alias("letters"), F.aggregate(F.map_values("o"), F.lit(0).cast("bigint"), lambda n, x: n + F.length(tx.cut_option_tail(x))).alias("chars"))


_LAW = "SELECT doc_id, CAST(count(*) AS INT) AS articles, CAST(count(DISTINCT art) AS INT) AS numbers, CAST(sum(length(body)) AS BIGINT) AS chars FROM (SELECT doc_id, art, regexp_replace(string_agg(rest, '' ORDER BY i), '[\\s\\p{Z}\\x{85}\\x{b}]+', '', 'g') AS body FROM (SELECT *, sum(CASE WHEN no <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS seg, max(CASE WHEN no <> '' THEN i END) OVER (PARTITION BY doc_id ORDER BY i) AS at_i, CASE WHEN no <> '' THEN regexp_replace(line, '^[ \\t　]*第[ \\t　]*\\d+(?:[ \\t　]*[-－之][ \\t　]*\\d+)?[ \\t　]*條', '') ELSE line END AS rest, last_value(nullif(no, '') IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i) AS art FROM (SELECT *, regexp_extract(line, '^[ \\t　]*第[ \\t　]*(\\d+(?:[ \\t　]*[-－之][ \\t　]*\\d+)?)[ \\t　]*條(?:[ \\t　]|$)', 1) AS no FROM (SELECT doc_id, unnest(string_split(translate(text, '０１２３４５６７８９', '0123456789'), chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL AND source = 'law_text') x) y) z WHERE seg > 0 GROUP BY doc_id, seg, art) w GROUP BY doc_id"


@query(_LAW)
def par11_law_articles(t):
    """Law texts to articles: how many, how many different, and how long."""
    d = t.documents.where("text is not null and source = 'law_text'").select("doc_id", parsing.law_articles(F.col("text")).alias("a")).where("size(a) > 0")
    chars = F.aggregate("a", F.lit(0).cast("bigint"), lambda n, x: n + F.length(F.regexp_replace(x["body"], r"(?U)\s+", "")))
    return d.select("doc_id", F.size("a").alias("articles"), F.size(F.array_distinct(F.transform("a", lambda x: x["art"]))).alias("numbers"), chars.alias("chars"))


@query(f"SELECT {paper()} AS paper, CAST(no AS INT) AS no, CASE WHEN answer_status = 'free' THEN 'free' WHEN len(letters) > 1 THEN 'multi' ELSE 'changed' END AS kind, CASE WHEN answer_status = 'free' THEN '' ELSE array_to_string(letters, '') END AS accept FROM (SELECT *, list_sort(list_distinct(list_filter(coalesce(accept, []), lambda x: regexp_full_match(x, '[A-E]')))) AS letters FROM <q> y) q WHERE no IS NOT NULL AND {paper()} <> '' AND (answer_status = 'free' OR len(letters) > 0)")
def par12_answer_remarks(t):
    """Remarks of each paper written out, with the neighbours 1 and 16 told apart, and read back."""
    letters = F.array_sort(F.array_distinct(F.filter(F.coalesce("accept", F.array().cast("array<string>")), lambda x: x.rlike("^[A-E]$"))))
    q = t.q("no", "answer_status", "accept").select(gates.paper_of(F.col("qid")).alias("paper"), "qid", "no", (F.col("answer_status") == "free").alias("free"), letters.alias("letters")).where("no is not null and paper <> '' and (coalesce(free, false) or size(letters) > 0)")
    said = F.concat(F.lit("第 "), F.col("no").cast("string"), F.when(F.col("free"), " 題一律給分").when(F.size("letters") > 1, F.concat(F.lit("題答案"), F.translate(F.array_join("letters", "或"), "ABCDE", "ＡＢＣＤＥ"), F.lit("均可"))).otherwise(F.concat(F.lit("題答案更正為"), F.array_join("letters", ""))))
    text = q.groupBy("paper").agg(F.concat(F.lit("1 A 2 B\n備 註："), F.array_join(F.array_sort(F.collect_list(said)), "，\n"), F.lit("。")).alias("text"))  # a paper's questions
    return text.select("paper", F.explode(parsing.answer_remarks(F.col("text"))).alias("r")).select("paper", "r.*")


@query(f"SELECT DISTINCT group_id, CAST(a AS INT) AS a, CAST(b AS INT) AS b, passage FROM ({_GROUPS}) g WHERE b - a < 10 AND length(passage) BETWEEN 1 AND 590")
def par13_shared_cases(t):
    g = t.q("group_id", "no", "passage").where("group_id is not null and no is not null").groupBy(gates.paper_of(F.col("qid")).alias("paper"), "group_id").agg(F.min("no").alias("a"), F.max("no").alias("b"), _one_line(F.min("passage")).alias("p"))
    text = F.concat(F.lit("前文。情況題："), "p", F.lit("依此回答第 "), F.col("a").cast("string"), F.lit(" 題至第 "), F.col("b").cast("string"), F.lit(" 題。"))
    cases = g.where(F.length("p").between(1, 590)).select("group_id", F.explode(parsing.shared_cases(text)).alias("c")).select("group_id", "c.a", "c.b", F.regexp_replace("c.passage", "依此回答$", "").alias("passage"))
    return cases.distinct()


@query(f"SELECT {paper()} AS paper, CAST(no AS INT) AS no, answer FROM <q> q WHERE no IS NOT NULL AND regexp_full_match(answer, '[A-E]+|／') AND {paper()} <> ''")
def join04_answer_pairs(t):
    """Answer tables of papers, as lines of cells, to pairs of number and answer."""
    q = t.q("no", "answer").select(gates.paper_of(F.col("qid")).alias("paper"), "no", "answer").where("no is not null and answer rlike '^([A-E]+|／)$' and paper <> ''")
    cells = q.select("paper", F.col("no").alias("line_no"), F.posexplode(F.array(F.lit("題號"), F.col("no").cast("string"), F.regexp_replace("answer", "／", "/"), F.lit("備註"))).alias("cell_no", "cell"))
    return landing.answer_pairs(cells.withColumnRenamed("paper", "file")).withColumnRenamed("file", "paper")


SUBJECTS = {"國文": "chinese", "國語文": "chinese", "英文": "english", "數學": "math", "數學a": "math_a", "社會": "social", "自然": "science"}
_SUBJECT = "CASE " + " ".join(f"WHEN contains(subject, '{k}') THEN '{v}'" for k, v in {"國文": "chinese", "英文": "english", "數學": "math", "社會": "social", "自然": "science"}.items()) + " END"
_FILES = f"SELECT row_id, CASE WHEN year BETWEEN 100 AND 199 THEN year END AS year, {_SUBJECT} AS subject, CASE row_id % 4 WHEN 0 THEN '試卷' WHEN 1 THEN '答案' WHEN 3 THEN '試卷' END AS kind FROM bank WHERE year IS NOT NULL AND subject IS NOT NULL"


def _files(t):
    kind = F.element_at(F.array(*map(F.lit, ("試卷", "答案", "答題卷", "試題"))), (F.col("row_id") % 4 + 1).cast("int"))
    name = F.concat(F.translate(F.col("year").cast("string"), "0123456789", "０１２３４５６７８９"), F.lit(" 學測"), "subject", kind, F.lit(".pdf"))
    return t.bank.where("year is not null and subject is not null").select("row_id", name.alias("name"), parsing.classify_file(name, SUBJECTS).alias("c")).select("row_id", "name", "c.*")


@query(f"SELECT row_id, CAST(year AS INT) AS year, subject, kind, CASE WHEN year IS NULL THEN 'year' WHEN subject IS NULL THEN 'subject' WHEN kind IS NULL THEN 'kind' ELSE '' END AS fault FROM ({_FILES}) f")
def prd05_file_classes(t):
    return _files(t).select("row_id", "year", "subject", "kind", "fault")


@query(f"SELECT year, subject, kind, min(row_id) AS first_row FROM ({_FILES}) f WHERE year IS NOT NULL AND subject IS NOT NULL AND kind IS NOT NULL GROUP BY ALL")
def src09_first_hits(t):
    """The nested table year, subject, kind of first hits, unfolded again."""
    nested = parsing.first_hits(_files(t).where("fault = ''"), ["row_id"], "row_id")
    return nested.select("year", F.explode("table").alias("subject", "kinds")).select("year", "subject", F.explode("kinds").alias("kind", "first_row"))


@query("SELECT row_id, rl(stem, '本題附圖|下圖|如圖|右圖|附圖') OR (coalesce(cardinality(options), 0) > 0 AND len(list_filter(map_values(options), lambda o: trim(coalesce(o, ''), ' ') <> '')) = 0) AS own FROM bank WHERE group_id IS NOT NULL AND stem IS NOT NULL")
def prd04_own_figures(t):
    return t.bank.where("group_id is not null and stem is not null").select("row_id", parsing.own_figure(F.col("stem"), F.col("options")).alias("own"))


@query("SELECT expl_id, CAST(len(regexp_extract_all(t, '(?:信心|把握|可信度)[^。！？]{0,6}(?:高|中|低|不足|有限)[^。！？]{0,4}[。！？]')) AS INT) AS n FROM explanations WHERE rl(t, '(?:信心|把握|可信度)[^。！？]{0,6}(?:高|中|低|不足|有限)[^。！？]{0,4}[。！？]')")
def prd12_leaked_confidence(t):
    return t.explanations.select("expl_id", F.size(parsing.leaked_confidence(F.col("t"))).alias("n")).where("n > 0")


@query(f"SELECT row_id, array_to_string(list_sort(list_filter(map_keys(options), lambda k: contains({squeeze('coalesce(options[k], chr(0))')}, s))), '') AS letters FROM (SELECT row_id, options, substr({squeeze('lead(stem) OVER (PARTITION BY ' + paper() + ' ORDER BY no, qid)')}, 1, 20) AS s FROM <q> q WHERE no IS NOT NULL) x WHERE length(s) >= 20 AND len(list_filter(map_keys(options), lambda k: contains({squeeze('coalesce(options[k], chr(0))')}, s))) > 0")
def prd20_option_bleed(t):
    q = t.q("no", "stem", "options").where("no is not null").withColumn("nxt", F.lead("stem").over(Window.partitionBy(gates.paper_of(F.col("qid"))).orderBy("no", "qid")))
    return q.select("row_id", F.array_join(parsing.bleeds(F.col("options"), F.col("nxt")), "").alias("letters")).where("letters <> ''")


@query("SELECT row_id FROM bank WHERE rl(stem, '得\\s*(?:mg|kg|mL|ml|cm|mm|km|m|g|L|s|N|J|W|V|A|Pa|mol)\\s*[．.。·/，,]')")
def prd22_orphan_units(t):
    return t.bank.where(parsing.orphan_units(F.col("stem"))).select("row_id")


@query("SELECT row_id, letter, regexp_replace(o, '(?s)\\s*(?:請翻頁繼續作答|背面尚有試題|第\\s*\\d+\\s*頁\\s*共\\s*\\d+\\s*頁|請勿攜出).*$', '') AS text FROM (SELECT row_id, unnest(map_keys(options)) AS letter, unnest(map_values(options)) AS o FROM bank) x WHERE rl(o, '請翻頁繼續作答|背面尚有試題|第\\s*\\d+\\s*頁\\s*共\\s*\\d+\\s*頁|請勿攜出')")
def prd24_option_furniture(t):
    o = t.bank.select("row_id", F.explode("options").alias("letter", "o"))
    cut = parsing.cut_furniture(F.col("o"))
    return o.where(cut != F.col("o")).select("row_id", "letter", cut.alias("text"))


_SHA = "sha256(array_to_string(list_sort(list(DISTINCT qid)), ','))"
_PARITY = f"""WITH blocks AS (SELECT {paper()} AS block, min(loaded_at) + INTERVAL 30 DAY AS newer_than FROM bank WHERE {paper()} <> '' GROUP BY 1),
ledger AS (SELECT {paper()} AS block, 'bank' AS arm, {_SHA} AS prompt_sha, sha256(array_to_string(list_sort(list(DISTINCT qid) FILTER (removed_at IS NULL OR parse = 'ok')), ',')) AS delivered_sha, 'agent' AS channel, max(loaded_at) AS ts FROM bank WHERE {paper()} <> '' GROUP BY 1
  UNION ALL SELECT {paper()}, 'expl', {_SHA}, NULL, CASE WHEN count(*) % 2 = 0 THEN 'cli' ELSE 'agent' END, max(merged_at) FROM explanations WHERE {paper()} <> '' GROUP BY 1),
grid AS (SELECT b.block, b.newer_than, a.arm FROM blocks b CROSS JOIN (VALUES ('bank'), ('expl')) a(arm)),
j AS (SELECT g.*, l.prompt_sha, l.delivered_sha, l.channel, l.ts, count(DISTINCT l.prompt_sha) OVER (PARTITION BY g.block) AS prompts FROM grid g LEFT JOIN ledger l ON g.block = l.block AND g.arm = l.arm)
SELECT block, arm, CASE WHEN prompt_sha IS NULL THEN 'missing' WHEN ts < newer_than THEN 'stale' WHEN delivered_sha <> prompt_sha THEN 'drift' WHEN prompts > 1 THEN 'unequal' WHEN channel = 'agent' AND delivered_sha IS NULL THEN 'unverified' ELSE 'ok' END AS state FROM j"""


@query(_PARITY)
def join08_parity_states(t):
    """Papers as blocks, the bank and the explanations as arms: the list of questions that either was given."""
    listed = lambda c: F.sha2(F.array_join(F.array_sort(F.collect_set(c)), ","), 256)  # noqa: E731 a paper's questions
    own = gates.paper_of(F.col("qid")).alias("block")
    b = t.bank.select(own, "qid", "loaded_at", "removed_at", "parse").where("block <> ''")
    bank = b.groupBy("block").agg(F.lit("bank").alias("arm"), listed("qid").alias("prompt_sha"), listed(F.when(F.col("removed_at").isNull() | (F.col("parse") == "ok"), F.col("qid"))).alias("delivered_sha"), F.lit("agent").alias("channel"), F.max("loaded_at").alias("ts"))
    e = t.explanations.select(own, "qid", "merged_at").where("block <> ''")
    expl = e.groupBy("block").agg(F.lit("expl").alias("arm"), listed("qid").alias("prompt_sha"), F.lit(None).cast("string").alias("delivered_sha"), F.when(F.count("*") % 2 == 0, "cli").otherwise("agent").alias("channel"), F.max("merged_at").alias("ts"))
    blocks = b.groupBy("block").agg((F.min("loaded_at") + F.expr("interval 30 days")).alias("newer_than"))
    return parity.parity(bank.unionByName(expl), t.spark.createDataFrame([("bank",), ("expl",)], "arm string"), blocks)


_PURE = "regexp_replace(coalesce({0}, ''), '[\\s\\p{{Z}}\\x{{85}}\\x{{b}}\\p{{Nd}}.．()]+', '', 'g')"


@query(f"SELECT doc, no, CASE WHEN len(regexp_extract_all(s, '[一-鿿]')) >= 8 THEN s END AS stem, CASE WHEN n >= 4 THEN n END AS options FROM (SELECT {paper()} AS doc, CAST(no AS INT) AS no, {_PURE.format('stem')} AS s, CAST(len(list_filter(map_keys(options), lambda k: k IN ('A', 'B', 'C', 'D', 'E'))) AS INT) AS n, row_number() OVER (PARTITION BY {paper()}, no ORDER BY row_id) AS k FROM <q> q WHERE no IS NOT NULL AND {paper()} <> '') x WHERE k = 1 AND length(s) >= 8")
def par07_items_by_position(t):
    """Papers laid out as spans, a stem or an option each, and read back by position (PAR-7, PAR-8)."""
    pure = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)[\s\d.．()]+", "")
    q = t.q("no", "stem", "options").select(gates.paper_of(F.col("qid")).alias("doc"), "row_id", "no", pure(F.col("stem")).alias("s"), "options").where("no is not null and doc <> ''")
    q = q.groupBy("doc", "no").agg(F.min_by(F.struct("s", "options"), "row_id").alias("r")).select("doc", "no", "r.*").where("length(s) >= 8")
    lines = F.concat(F.array(F.concat(F.col("no").cast("string"), F.lit(". "), "s")), F.transform(F.filter(F.coalesce(F.map_entries("options"), F.array()), lambda e: e["key"].isin(*"ABCDE")), lambda e: F.concat(F.lit("("), e["key"], F.lit(") "), pure(e["value"]))))
    spans = q.select("doc", F.col("no").alias("page"), F.posexplode(lines).alias("i", "text")).select("doc", "page", F.lit(50.0).alias("x0"), (60.0 + 18 * F.col("i")).alias("y0"), "text")
    return parsing.items_by_position(spans).select("doc", "no", "stem", F.size("options").alias("options").try_cast("int")).select("doc", "no", "stem", F.when(F.col("options") > 0, F.col("options")).alias("options"))


@query("SELECT row_id, concat_ws(',', no, no + 1, no + 2, no + 3) AS numbers FROM bank WHERE no IS NOT NULL AND row_id % 2 = 0 UNION ALL SELECT row_id, concat_ws(',', no, no + 1, no + 2, no + 3) FROM bank WHERE no IS NOT NULL AND row_id % 2 = 1")
def par17_unrotated_numbers(t):
    """Numbers of options, moved up by one in every second row, moved back."""
    n = [(F.col("no") + i).cast("string") for i in range(4)]
    numbers = F.when(F.col("row_id") % 2 == 0, F.array(*n[1:], F.lit(""))).otherwise(F.array(*n))
    back = parsing.unrotated(F.when(F.col("row_id") % 2 == 0, n[0]).otherwise(F.lit("")), numbers, F.array(*n))
    return t.bank.where("no is not null").select("row_id", F.array_join(back, ",").alias("numbers"))


@query(f"SELECT row_id, sha256({squeeze('stem')}) AS h FROM bank WHERE stem IS NOT NULL AND passage IS NOT NULL AND length({squeeze('passage')}) > 0")
def par18_cut_pools(t):
    """Stems with a table's characters, here the passage's in another order, behind them, cut again."""
    stem, pool = tx.squeeze(F.col("stem")), tx.squeeze(F.col("passage"))
    b = t.bank.where("stem is not null and passage is not null").select("row_id", stem.alias("s"), pool.alias("p")).where("length(p) > 0")
    return b.select("row_id", F.sha2(parsing.cut_pool_col(F.concat("s", F.reverse("p")), F.col("p")), 256).alias("h"))


@query("SELECT doc_id AS id, CAST(length(text) - length(replace(text, '的', '')) AS INT) AS unknown FROM documents WHERE text IS NOT NULL AND source IS NOT NULL")
def nrm21_glyphs(t):
    """Private characters in place of two frequent ones, one of which the paper's map knows; the other is kept and counted."""
    d = t.documents.where("text is not null and source is not null").select(F.col("doc_id").alias("id"), F.col("source").alias("paper"), F.lit("F1").alias("font"), F.translate("text", "一的", "\ue001\ue002").alias("text"))
    glyphs = t.documents.where("source is not null").select(F.col("source").alias("paper"), F.lit("F1").alias("font"), F.lit("\ue001").alias("seen"), F.lit("一").alias("true")).distinct()
    return parsing.repair_glyphs(d, glyphs).select("id", "unknown")


_PICKS = "SELECT qid, no, coalesce(group_id, qid) AS chain, row_number() OVER (ORDER BY sha256(qid), qid) AS pos FROM <q> q WHERE qid IS NOT NULL AND subject = '國文'"


@query(f"SELECT qid, CAST(row_number() OVER (ORDER BY min_pos, no NULLS FIRST, qid) AS BIGINT) AS place FROM (SELECT *, min(pos) OVER (PARTITION BY chain) AS min_pos FROM ({_PICKS}) p) x")
def drv12_chain_order(t):
    """A drawn order of one subject's questions with the members of a chain gathered at the first one drawn, in their own order.

    Places within cells of the hash; the chain's first place is its least hash.
    """
    from stemforge.operators.ranking import rank_within

    q = t.q("no", "group_id", "subject").where("qid is not null and subject = '國文'").select("qid", "no", F.coalesce("group_id", "qid").alias("chain"), F.concat(F.sha2("qid", 256), "qid").alias("h"))
    first = q.groupBy("chain").agg(F.min("h").alias("first"))
    ranked = rank_within(q.join(first, "chain").withColumn("one", F.lit(1)), ["one"], F.substring("first", 1, 2), ["first", F.asc_nulls_first("no"), "qid"], "place")
    return ranked.select("qid", "place")


_MARKED = "SELECT row_id, list_filter(list_transform(map_values(options), lambda o: regexp_extract_all(coalesce(o, ''), '[①-⑳]')), lambda m: len(m) > 0) AS m, list_transform(list_filter(map_values(options), lambda o: regexp_matches(coalesce(o, ''), '[①-⑳]')), lambda o: regexp_replace(o, '[\\s\\p{Z}僅]+', '', 'g')) AS p, len(list_filter(map_values(options), lambda o: regexp_matches(coalesce(o, ''), '^[\\x{e000}-\\x{f8ff}]'))) > 0 AS residual FROM bank WHERE options IS NOT NULL"


@query(f"SELECT row_id, concat_ws(',', CASE WHEN dup THEN 'within_dup' END, CASE WHEN iden AND NOT (NOT dup AND len(m) >= 2 AND len(list_distinct(list_transform(m, lambda x: list_sort(x)))) = 1 AND len(list_distinct(m)) >= 2) THEN 'cross_iden' END, CASE WHEN residual THEN 'marker_residual' END) AS signs FROM (SELECT *, len(list_filter(m, lambda x: len(list_distinct(x)) < len(x))) > 0 AS dup, len(list_distinct(p)) < len(p) AS iden FROM ({_MARKED}) x) y WHERE dup OR (iden AND NOT (len(m) >= 2 AND len(list_distinct(list_transform(m, lambda x: list_sort(x)))) = 1 AND len(list_distinct(m)) >= 2)) OR residual")
def prd14_option_collapse(t):
    return t.bank.where("options is not null").select("row_id", F.array_join(parsing.option_collapse(F.col("options")), ",").alias("signs")).where("signs <> ''")
