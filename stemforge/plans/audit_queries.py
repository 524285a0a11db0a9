"""Queries of landing, sinks, sampling and derived checks. What no table holds (files, drafts, chunks) is written from
columns and read back; the SQL takes the columns."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stemforge.functions import textcols as tx
from stemforge.functions.brackets import halve_brackets_col
from stemforge.functions.lookalike import normal_form
from stemforge.operators import gates, maintain
from stemforge.operators.citations import key_numbers_col, normalize_numerals
from stemforge.plans.dual import duck_sql
from stemforge.plans.question_queries import Tables
from stemforge.plans.statements import paper, squeeze
from stemforge.session import fresh_dir
from stemforge.sources import landing

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[f.__name__] = duck_sql(sql)
        return f

    return register


# --- sources


@query("SELECT row_id, qid, stem FROM bank")
def src01_json_bank(t):
    """The bank as JSON in the shared folder, read whole with a schema."""
    path = fresh_dir(t.spark, "bank-json")
    t.bank.select("row_id", "qid", "stem").write.json(path)
    return t.spark.read.schema("row_id bigint, qid string, stem string").json(path)


_SHAPES = "expl_id % 6"


@query(f"SELECT CASE WHEN {_SHAPES} = 5 THEN 'bad' ELSE 'item' END AS kind, CASE WHEN {_SHAPES} = 5 THEN NULL ELSE expl_id END AS expl_id, CASE WHEN {_SHAPES} = 5 THEN 1 ELSE CASE WHEN {_SHAPES} = 0 THEN 2 ELSE 1 END END AS n FROM explanations")
def src02_landed_items(t):
    """Explanations in the shapes of files that tools leave: a list (twice the item), {items}, {questions}, {explanations}, one object, and half-written ones, which are counted (DRV-1, DRV-2, SRC-3)."""
    one = F.to_json(F.struct("expl_id", "t"))
    value = F.element_at(
        F.array(F.concat(F.lit("["), one, F.lit(","), one, F.lit("]")), F.concat(F.lit('{"items":['), one, F.lit("]}")), F.concat(F.lit('{"questions":['), one, F.lit("]}")), F.concat(F.lit('{"explanations":['), one, F.lit("]}")), one, F.concat(F.lit("["), one, F.lit(","))),
        (F.col("expl_id") % 6 + 1).cast("int"),
    )
    docs = landing.json_docs(t.explanations.select(F.col("expl_id").cast("string").alias("file"), value.alias("value")))
    items = landing.json_items(docs).select(F.try_variant_get("item", "$.expl_id", "bigint").alias("expl_id")).groupBy("expl_id").agg(F.count("*").cast("int").alias("n"))
    bad = docs.where("bad").select(F.lit("bad").alias("kind"), F.lit(None).cast("bigint").alias("expl_id"), F.lit(1).alias("n"))
    return items.select(F.lit("item").alias("kind"), "expl_id", "n").unionByName(bad)


@query(f"SELECT qid, {squeeze('t')} AS text FROM explanations WHERE t IS NOT NULL AND qid IS NOT NULL AND trim(qid, ' ') <> '' AND NOT contains(qid, chr(10))")
def src03_draft_items(t):
    """Explanations as drafts with header lines, split again."""
    e = t.explanations.where("t is not null and qid is not null and trim(qid) <> '' and not contains(qid, '\n')").select(F.col("expl_id").alias("file"), "qid", F.concat(F.lit("序言\nQ: 1\n舊\nQ: @"), "expl_id", F.lit("\n"), tx.squeeze(F.col("t")), F.lit("\n\n")).alias("value"))
    items = landing.draft_items(e.select("file", "value")).where("startswith(qid, '@')").select("file", "text")
    return e.select("file", "qid").join(items, "file").select("qid", "text")


@query("SELECT doc_id AS file, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INT) AS line_no, CAST(length(unnest(string_split(text, chr(10)))) AS INT) AS chars FROM documents WHERE text IS NOT NULL AND NOT contains(text, chr(13))")
def src04_text_lines(t):
    d = t.documents.where("text is not null and not contains(text, '\r')").select(F.col("doc_id").alias("file"), F.col("text").alias("value"))
    return landing.lines_of(d).select("file", "line_no", F.length("line").alias("chars"))


@query("SELECT DISTINCT sha1, CASE width % 3 WHEN 0 THEN 'https://a.example/f/' ELSE 'https://b.example/' END || CASE width % 3 WHEN 1 THEN 'list/' WHEN 2 THEN 'f/' ELSE '' END || filename AS link, filename AS name FROM figure_files WHERE filename IS NOT NULL AND regexp_full_match(filename, '[A-Za-z0-9_.]+')")
def src08_links(t):
    """Links of listing pages: absolute, from the root, and relative."""
    f = t.figure_files.where(F.col("filename").rlike("^[A-Za-z0-9_.]+$"))
    href = F.when(F.col("width") % 3 == 0, F.concat(F.lit("https://a.example/f/"), "filename")).when(F.col("width") % 3 == 2, F.concat(F.lit("/f/"), "filename")).otherwise("filename")
    href = F.when(F.col("width") % 3 == 0, F.concat(F.lit("https://a.example/f/"), "filename")).when(F.col("width") % 3 == 2, F.concat(F.lit("/f/"), "filename")).otherwise(F.col("filename"))
    pages = f.select(F.col("sha1").alias("url"), F.concat(F.lit('<p>x</p><a class="k" href="'), href, F.lit('">')).alias("html"))
    return landing.links(pages, "https://b.example/list").select(F.col("url").alias("sha1"), "link", "name").distinct()


@query("SELECT doc_id, octet_length(encode(text)) + 9 > 1024 AND doc_id % 3 <> 0 AS valid FROM documents WHERE text IS NOT NULL")
def src10_valid_files(t):
    """Documents dressed as files with and without their magic bytes."""
    head = F.when(F.col("doc_id") % 3 == 0, "%TXT").otherwise("%PDF")
    return t.documents.where("text is not null").select("doc_id", landing.valid_pdf(F.concat(head, "text", F.lit("%%EOF")).cast("binary")).alias("valid"))


@query("SELECT user_id, CAST(max_by(n, ts) AS INT) AS last_n, CAST(sum(n) AS BIGINT) AS all_n FROM (SELECT user_id, ts, (ts, event_id) AS k, event_id % 1000 AS n FROM (SELECT user_id, event_id, max(ts) AS ts FROM answer_events GROUP BY 1, 2) x) y GROUP BY user_id".replace("max_by(n, ts)", "max_by(n, k)"))
def src13_token_logs(t):
    """The last and the sum of ``tokens used N`` in each user's log lines."""
    e = t.answer_events.groupBy("user_id", "event_id").agg(F.max("ts").alias("ts"))
    line = F.concat(F.lit("tokens used 1, retry; tokens used "), (F.col("event_id") % 1000).cast("string"))
    n = F.element_at(F.regexp_extract_all(line, F.lit(r"tokens used (\d+)"), 1), -1).cast("int")
    return e.groupBy("user_id").agg(F.max_by(n, F.struct("ts", "event_id")).alias("last_n"), F.sum(n).alias("all_n"))


_CELLS = r"SELECT row_id, count(*) AS cells, CAST(sum(length(cell)) AS BIGINT) AS chars FROM (SELECT row_id, trim(unnest(string_split(line, '|')), ' ') AS cell FROM (SELECT row_id, unnest(string_split(table_md, chr(10))) AS line FROM bank WHERE table_md IS NOT NULL) x WHERE len(regexp_extract_all(line, '\|')) >= 2 AND NOT regexp_full_match(line, '[\s|:\-]+')) y WHERE cell <> '' GROUP BY row_id"


@query(_CELLS)
def prd02_table_cells(t):
    c = landing.table_cells(landing.lines_of(t.bank.where("table_md is not null").select(F.col("row_id").alias("file"), F.col("table_md").alias("value"))))
    return c.groupBy(F.col("file").alias("row_id")).agg(F.count("*").alias("cells"), F.sum(F.length("cell")).alias("chars"))


# --- sinks


@query("SELECT count(*) AS rows, count(DISTINCT qid) AS keys, 'ok' AS guard FROM <q> q")
def snk01_staged_write(t):
    """The latest deliveries by a staged write, read back; then an empty result and one with repeated keys, which replace nothing (SNK-1 to SNK-4)."""
    path = fresh_dir(t.spark, "staged")
    q = t.q("stem").select("qid", "row_id", "stem")
    maintain.staged_write(q, path, ["qid"])
    guard = "ok"
    for bad in (q.limit(0), q.unionByName(q)):
        try:
            maintain.staged_write(bad, path, ["qid"])
            guard = "replaced"
        except ValueError:
            pass
    return t.spark.read.parquet(path).agg(F.count("*").alias("rows"), F.countDistinct("qid").alias("keys"), F.lit(guard).alias("guard"))


@query("SELECT DISTINCT f.filename AS name, CASE WHEN g.sha1 IS NOT NULL THEN 'data:image/png;base64,' || base64(encode(repeat(g.sha1, 3))) END AS uri FROM figure_files f LEFT JOIN (SELECT filename, max(sha1) AS sha1 FROM figure_files WHERE deleted_at IS NULL GROUP BY filename) g ON f.filename = g.filename WHERE f.filename IS NOT NULL")
def snk06_data_uris(t):
    """Images as data URIs; deleted ones are missing."""
    files = t.figure_files.where("deleted_at is null and filename is not null").groupBy("filename").agg(F.max("sha1").alias("sha1"))
    files = files.select(F.concat(F.lit("file:/x/"), "filename").alias("path"), F.repeat("sha1", F.lit(3)).cast("binary").alias("content"))
    return landing.data_uris(files, t.figure_files.where("filename is not null").select(F.col("filename").alias("name")))


# --- normalisation


@query("SELECT expl_id, sha256(nfc_normalize(t)) AS h FROM explanations WHERE t IS NOT NULL")
def nrm02_composed_texts(t):
    return t.explanations.where("t is not null").select("expl_id", F.sha2(normal_form(F.col("t"), F.lit("NFC")), 256).alias("h"))


@query()
def nrm15_numerals_in_text(t):
    """Article texts with numerals as digits, and their key numbers; checked by unit tests."""
    a = t.anchor_packs.select("pack_row", F.explode("articles").alias("art", "text")).where("text is not null")
    digits = F.pandas_udf(lambda s: s.map(normalize_numerals), "string")
    return a.select("pack_row", "art", F.length(digits(F.col("text"))).alias("chars"), F.array_join(key_numbers_col(F.col("text")), ",").alias("numbers"))


@query("SELECT row_id, CAST(CAST(no AS BIGINT) * CASE row_id % 4 WHEN 0 THEN 1000 WHEN 1 THEN 10000 WHEN 2 THEN 100000000 ELSE 1 END AS VARCHAR) || CASE WHEN row_id % 4 = 3 THEN '.5' ELSE '' END AS plain FROM bank WHERE no IS NOT NULL")
def nrm17_scaled_numbers(t):
    scale = F.element_at(F.array(F.lit("千"), F.lit("萬"), F.lit("億"), F.lit("")), (F.col("row_id") % 4 + 1).cast("int"))
    value = F.when(F.col("row_id") % 4 == 3, F.concat(F.col("no").cast("string"), F.lit(".50"))).otherwise(F.format_number("no", 0))
    return t.bank.where("no is not null").select("row_id", tx.scaled_number(value, scale).alias("plain"))


@query("SELECT group_id, qid, CAST(no - min(no) OVER (PARTITION BY group_id) + 1 AS INT) AS label FROM <q> q WHERE group_id IS NOT NULL AND no IS NOT NULL")
def nrm22_group_labels(t):
    """Numbers of a group counted from its first."""
    q = t.q("group_id", "no").where("group_id is not null and no is not null")
    return q.select("group_id", "qid", (F.col("no") - F.min("no").over(Window.partitionBy("group_id")) + 1).cast("int").alias("label"))


# --- sampling


@query("SELECT subject, row_id FROM (SELECT subject, row_id, row_number() OVER (PARTITION BY subject ORDER BY sha256('7:' || row_id), row_id) AS k FROM bank) x WHERE k <= 3")
def smp01_seeded_sample(t):
    """Three rows of each subject by a seeded hash."""
    h = F.sha2(F.concat(F.lit("7:"), F.col("row_id").cast("string")), 256)
    return t.bank.select("subject", "row_id", F.row_number().over(Window.partitionBy("subject").orderBy(h, "row_id")).alias("k")).where("k <= 3").drop("k")


_RATES = "SELECT subject, year, count(*) AS n, count(*) FILTER (parse = 'review') / CAST(count(*) AS DOUBLE) AS rate FROM <q> q WHERE year IS NOT NULL GROUP BY subject, year"


@query(f"SELECT subject, year, n, CASE WHEN rate <= 0.03 AND lag(rate) OVER (PARTITION BY subject ORDER BY year) <= 0.03 THEN 'sample' ELSE 'all' END AS policy FROM ({_RATES}) r")
def smp04_sampling_policy(t):
    """A batch (subject and year) may be sampled once it and the one before have at most 3 % to review; else all are looked at."""
    r = t.q("subject", "year", "parse").where("year is not null").groupBy("subject", "year").agg(F.count("*").alias("n"), (F.count_if(F.col("parse") == "review") / F.count("*")).alias("rate"))
    old = F.lag("rate").over(Window.partitionBy("subject").orderBy("year"))
    return r.select("subject", "year", "n", F.when((F.col("rate") <= 0.03) & (old <= 0.03), "sample").otherwise("all").alias("policy"))


# --- sets and derived checks


REGISTRY = ["row_id", "qid", "exam", "year", "subject", "no", "type", "stem", "options", "answer", "group_id"]


@query("SELECT row_id, array_to_string(list_sort(list_filter(['passage', 'figure', 'table_md', 'accept'], lambda x: CASE x WHEN 'passage' THEN passage IS NOT NULL WHEN 'figure' THEN figure IS NOT NULL WHEN 'table_md' THEN table_md IS NOT NULL ELSE accept IS NOT NULL END)), ',') AS keys FROM bank WHERE passage IS NOT NULL OR figure IS NOT NULL OR table_md IS NOT NULL OR accept IS NOT NULL")
def set07_unregistered_keys(t):
    """Keys of a row's JSON that the registry doesn't have."""
    j = F.to_json(F.struct(*REGISTRY, "passage", "figure", "table_md", "accept"))
    keys = F.array_sort(F.array_except(F.json_object_keys(j), F.array(*map(F.lit, REGISTRY))))
    return t.bank.select("row_id", F.array_join(keys, ",").alias("keys")).where("keys <> ''")


@query("SELECT expl_id, array_to_string(list_filter(['options', 'figure', 'passage'], lambda x: CASE x WHEN 'options' THEN rl(e.t, '[(（][A-E][)）]') AND coalesce(cardinality(q.options), 0) = 0 WHEN 'figure' THEN rl(e.t, '如圖|圖中|下圖') AND q.figure IS NULL ELSE rl(e.t, '本文|文中|上文') AND q.passage IS NULL END), ',') AS missing FROM explanations e JOIN <q> q ON e.qid = q.qid WHERE e.t IS NOT NULL AND ((rl(e.t, '[(（][A-E][)）]') AND coalesce(cardinality(q.options), 0) = 0) OR (rl(e.t, '如圖|圖中|下圖') AND q.figure IS NULL) OR (rl(e.t, '本文|文中|上文') AND q.passage IS NULL))")
def set08_conditioned_fields(t):
    """Fields that an explanation speaks of and its question doesn't have (JOIN-14)."""
    rules = {"options": ("[(（][A-E][)）]", F.coalesce(F.size("options"), F.lit(0)) <= 0), "figure": ("如圖|圖中|下圖", F.col("figure").isNull()), "passage": ("本文|文中|上文", F.col("passage").isNull())}
    j = t.explanations.where("t is not null").select("expl_id", "qid", "t").join(t.q("options", "figure", "passage"), "qid")
    missing = F.array_compact(F.array(*[F.when(F.col("t").rlike(p) & gone, F.lit(k)) for k, (p, gone) in rules.items()]))
    return j.select("expl_id", F.array_join(missing, ",").alias("missing")).where("missing <> ''")


@query("SELECT shape, count(*) AS n FROM (SELECT CASE WHEN options IS NULL THEN 'null' WHEN cardinality(options) = 0 THEN 'empty' WHEN len(list_filter(map_values(options), lambda o: coalesce(o, '') = '')) > 0 THEN 'gaps' ELSE 'full' END AS shape FROM bank) x GROUP BY shape")
def set09_option_shapes(t):
    """The shapes that a renderer has to know."""
    shape = F.when(F.col("options").isNull(), "null").when(F.size("options") == 0, "empty").when(F.exists(F.map_values("options"), lambda o: F.coalesce(o, F.lit("")) == ""), "gaps").otherwise("full")
    return t.bank.groupBy(shape.alias("shape")).agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN e.n IS NULL THEN 'open' WHEN e.good > 0 THEN 'settled' ELSE 'claimed' END AS state, count(*) AS debts FROM (SELECT qid FROM <q> q WHERE parse <> 'ok') d LEFT JOIN (SELECT qid, count(*) AS n, count(*) FILTER (t IS NOT NULL AND c = 'high') AS good FROM explanations GROUP BY qid) e ON d.qid = e.qid GROUP BY 1")
def set13_debts(t):
    """Questions to settle, one by one: open, claimed by a text, or settled by one of high level."""
    e = t.explanations.groupBy("qid").agg(F.count("*").alias("n"), F.count_if(F.col("t").isNotNull() & (F.col("c") == "high")).alias("good"))
    state = F.when(F.col("n").isNull(), "open").when(F.col("good") > 0, "settled").otherwise("claimed")
    return t.q("parse").where("parse <> 'ok'").join(e, "qid", "left").groupBy(state.alias("state")).agg(F.count("*").alias("debts"))


@query("SELECT subject, count(*) AS planted, count(*) FILTER (found) AS found FROM (SELECT q.subject, EXISTS (SELECT 1 FROM explanations e WHERE e.qid = q.qid AND e.c = 'low') AS found FROM <q> q WHERE q.parse = 'review') x GROUP BY subject")
def agg24_planted_recall(t):
    """Of the questions known to need review, those that a low level points to."""
    low = t.explanations.where("c = 'low' and qid is not null").select("qid").distinct().withColumn("hit", F.lit(True))
    j = t.q("subject", "parse").where("parse = 'review'").join(low, "qid", "left")
    return j.groupBy("subject").agg(F.count("*").alias("planted"), F.count("hit").alias("found"))


@query(f"SELECT h AS body, count(DISTINCT paper) AS papers FROM (SELECT {paper()} AS paper, sha256(string_agg({squeeze('stem')}, '|' ORDER BY {squeeze('stem')})) AS h FROM <q> q WHERE stem IS NOT NULL AND {paper()} <> '' GROUP BY 1) x GROUP BY h")
def dup04_papers_by_body(t):
    """Papers with the same body, whatever their names say."""
    q = t.q("stem").where("stem is not null").select(gates.paper_of(F.col("qid")).alias("paper"), tx.squeeze(F.col("stem")).alias("s")).where("paper <> ''")
    body = q.groupBy("paper").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("s")), "|"), 256).alias("body"))  # a paper's questions
    return body.groupBy("body").agg(F.count("*").alias("papers"))


@query("SELECT e.expl_id, array_to_string(list_sort(list_filter(list_distinct(regexp_extract_all(e.t, '[(（]([A-J])[)）]', 1)), lambda x: NOT list_contains(map_keys(n.options), x))), ',') AS gone FROM explanations e JOIN <q> n ON e.qid = n.qid JOIN <first> o ON o.qid = n.qid AND o.row_id <> n.row_id WHERE e.t IS NOT NULL AND n.options IS NOT NULL AND (o.stem IS DISTINCT FROM n.stem OR CAST(o.options AS VARCHAR) IS DISTINCT FROM CAST(n.options AS VARCHAR))")
def drv09_recheck(t):
    """Explanations of questions that changed, with the letters they speak of that aren't options any more."""
    old = t.first("stem", "options").select("qid", F.col("row_id").alias("old_row"), F.col("stem").alias("old_stem"), F.to_json("options").alias("old_options"))
    q = t.q("stem", "options").join(old, "qid").where("row_id <> old_row and options is not null").where(~F.col("stem").eqNullSafe(F.col("old_stem")) | ~F.to_json("options").eqNullSafe(F.col("old_options")))
    said = F.array_distinct(F.regexp_extract_all("t", F.lit("[(（]([A-J])[)）]"), 1))
    return t.explanations.where("t is not null").join(q.select("qid", "options"), "qid").select("expl_id", F.array_join(F.array_sort(F.array_except(said, F.map_keys("options"))), ",").alias("gone"))


@query("SELECT expl_id, CASE WHEN length(t) IS NULL THEN 'none' WHEN NOT rl(t, '[。！？]') THEN 'token' WHEN NOT contains(t, chr(10)) THEN 'sentence' ELSE 'paragraph' END AS scope FROM explanations")
def drv14_fix_scope(t):
    """How much of a text a fix touches: a token, a sentence, or paragraphs."""
    c = F.col("t")
    return t.explanations.select("expl_id", F.when(c.isNull(), "none").when(~c.rlike("[。！？]"), "token").when(~F.contains(c, F.lit("\n")), "sentence").otherwise("paragraph").alias("scope"))


@query(f"SELECT q.qid FROM <q> q WHERE {paper('q.')} NOT IN (SELECT {paper()} FROM explanations WHERE qid IS NOT NULL)")
def drv15_in_no_chunk(t):
    """Questions of papers that no chunk of explanations has."""
    done = t.explanations.where("qid is not null").select(gates.paper_of(F.col("qid")).alias("paper")).distinct()
    return t.q().select("qid", gates.paper_of(F.col("qid")).alias("paper")).join(done, "paper", "left_anti").select("qid")


@query(f"SELECT {paper('q.')} AS paper, count(*) AS inputs, count(e.qid) AS verdicts, count(*) = count(e.qid) AS complete FROM <q> q LEFT JOIN (SELECT DISTINCT qid FROM explanations WHERE t IS NOT NULL) e ON q.qid = e.qid GROUP BY 1")
def drv16_completeness(t):
    e = t.explanations.where("t is not null and qid is not null").select("qid").distinct().withColumn("v", F.lit(1))
    j = t.q().select("qid", gates.paper_of(F.col("qid")).alias("paper")).join(e, "qid", "left")
    return j.groupBy("paper").agg(F.count("*").alias("inputs"), F.count("v").alias("verdicts"), (F.count("*") == F.count("v")).alias("complete"))


@query("SELECT type, coalesce(reason, '-') AS reason, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY type) AS DOUBLE), 6) AS share FROM (SELECT type, unnest(review_reasons) AS reason FROM bank WHERE review_reasons IS NOT NULL) x GROUP BY type, reason")
def drv18_reasons_by_type(t):
    """Shares of the reasons to review by type of question."""
    r = t.bank.where("review_reasons is not null").select("type", F.explode("review_reasons").alias("reason"))
    n = r.groupBy("type", F.coalesce("reason", F.lit("-")).alias("reason")).agg(F.count("*").alias("n"))
    return n.select("type", "reason", "n", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("type")), 6).alias("share"))


@query("SELECT count(*) FILTER (o.bad AND NOT n.bad) AS fixed, CAST(sum(CAST(o.bad AS INT)) - sum(CAST(n.bad AS INT)) AS BIGINT) AS dropped, count(*) FILTER (n.bad AND NOT o.bad) AS new_faults FROM (SELECT qid, NOT rl(coalesce(stem, ''), '[。？！?!:：」][\\s　]*$') AS bad FROM <first> x) o JOIN (SELECT qid, NOT rl(coalesce(stem, ''), '[。？！?!:：」][\\s　]*$') AS bad FROM <q> y) n ON o.qid = n.qid")
def drv19_remedies(t):
    """What a repair claims against what the lint says: faults fixed, the drop in faults, and new ones."""
    bad = ~tx.ends_like_sentence(F.coalesce("stem", F.lit("")))
    j = t.first("stem").select("qid", bad.alias("was")).join(t.q("stem").select("qid", bad.alias("now")), "qid")
    return j.agg(F.count_if(F.col("was") & ~F.col("now")).alias("fixed"), (F.count_if("was") - F.count_if("now")).alias("dropped"), F.count_if(F.col("now") & ~F.col("was")).alias("new_faults"))


@query("SELECT row_id, CASE WHEN coalesce(cardinality(options), 0) = 0 THEN 'not_applicable' WHEN len(regexp_extract_all(translate(coalesce(answer, ''), 'ＡＢＣＤＥＦＧＨＩＪ', 'ABCDEFGHIJ'), '[A-J]')) = 0 THEN 'fail' ELSE 'pass' END AS state FROM bank")
def drv27_degenerate(t):
    """A question without options has no letters to check: not applicable, not a failure."""
    return t.bank.select("row_id", F.when(F.coalesce(F.size("options"), F.lit(0)) <= 0, "not_applicable").when(F.size(tx.answer_letters(F.col("answer"))) == 0, "fail").otherwise("pass").alias("state"))


@query()
def nrm10_formula_brackets(t):
    """Texts whose formulas' brackets become half-width; checked by unit tests."""
    fixed = halve_brackets_col(F.col("text"))
    return t.documents.where("contains(text, '（')").select("doc_id", "text", fixed.alias("fixed")).where("fixed <> text").select("doc_id", "fixed")


@query("SELECT expl_id, CASE WHEN len(list_filter(l[1:len(l) - 1], lambda x: NOT rl(x, '[。！？：；][\\s　]*$'))) = 0 THEN array_to_string(l, chr(10) || chr(10)) ELSE t END AS t FROM (SELECT expl_id, t, list_filter(string_split(t, chr(10)), lambda x: trim(x, ' ') <> '') AS l FROM explanations WHERE t IS NOT NULL) x")
def nrm12_paragraphs_or_same(t):
    return t.explanations.where("t is not null").select("expl_id", tx.paragraphs_or_same(F.col("t")).alias("t"))


@query("SELECT expl_id, CASE WHEN coalesce(c, '') = 'low' AND (expl_id % 3 = 0 OR coalesce(rl(t, '看不到|未提供|為空|無法核對|缺圖|未附'), FALSE)) THEN 'input_gap' WHEN c = 'low' THEN 'content_error' ELSE 'style' END AS basis FROM explanations")
def prd33_gap_language(t):
    """Low levels as content errors, every third with an evidence field that the payload lacks."""
    basis = F.when(F.col("c") == "low", "content_error").otherwise("style")
    evidence = F.when(F.col("expl_id") % 3 == 0, "figure_desc").otherwise("stem")
    return t.explanations.select("expl_id", tx.basis_of(basis, evidence, F.array(F.lit("stem"), F.lit("options")), F.col("t")).alias("basis"))


@query("SELECT doc_id, CAST(len(list_filter(regexp_extract_all(f, '\\\\\\(\\s*(.+?)\\s*\\\\\\)', 1), lambda x: regexp_full_match(x, '(?:\\\\times|[\\d\\s.,=＝+\\-×÷/^{}])+'))) AS INT) AS bare FROM (SELECT doc_id, text || ' \\(10^{' || doc_id || '}\\) \\( I_{x} \\)' AS f FROM documents WHERE text IS NOT NULL) x")
def prd29_bare_latex(t):
    """Documents with a formula of digits and one with a letter behind them."""
    f = F.concat("text", F.lit(" \\(10^{"), "doc_id", F.lit("}\\) \\( I_{x} \\)"))
    return t.documents.where("text is not null").select("doc_id", F.size(tx.bare_latex(f)).alias("bare"))


@query(f"SELECT p.row_id, len(list_filter(list_distinct(string_split(p.s, '')), lambda x: x <> '' AND length(p.s) - length(replace(p.s, x, '')) > length(b.s) - length(replace(b.s, x, '')))) = 0 AS within FROM (SELECT row_id, {squeeze('stem')} AS s FROM proof_stems) p JOIN (SELECT row_id, {squeeze('stem')} AS s FROM bank WHERE stem IS NOT NULL) b ON p.row_id = b.row_id")
def par19_multiset_containment(t):
    """Whether a proofread stem has nothing that the stored one doesn't have."""
    j = t.proof_stems.select("row_id", tx.squeeze(F.col("stem")).alias("p")).join(t.bank.where("stem is not null").select("row_id", tx.squeeze(F.col("stem")).alias("b")), "row_id")
    return j.select("row_id", tx.multiset_within(F.col("p"), F.col("b")).alias("within"))


@query("SELECT row_id, CAST(length(replace(stem, chr(10), '')) - length(replace(array_to_string(list_filter(string_split(stem, chr(10)), lambda x: NOT rl(x, '考科|試題|題本|卷別|翻頁|^ *第[ 0-9]+頁[ \r]*$')), ''), chr(10), '')) AS INT) AS dropped, NOT rl(stem, '[\\x{e000}-\\x{f8ff}]') AS in_domain FROM bank WHERE stem IS NOT NULL")
def par20_conservation(t):
    """What is kept and what is dropped make up the whole; the dropped characters have a name, and no private one is left."""
    lines = F.split("stem", "\n")
    kept, gone = (F.length(F.array_join(F.filter(lines, f), "")) for f in (lambda x: ~tx.furniture_line(x), tx.furniture_line))
    whole = F.length(F.replace("stem", F.lit("\n"), F.lit("")))
    dropped = F.when(kept + gone == whole, gone).otherwise(F.raise_error(F.lit("characters were lost")).cast("int"))
    return t.bank.where("stem is not null").select("row_id", dropped.alias("dropped"), (~F.col("stem").rlike("[\ue000-\uf8ff]")).alias("in_domain"))


_PAGE = f"(SELECT row_id, {squeeze('passage')} AS p, substr({squeeze('passage')}, row_id % 40 + 1) || 'x' AS n FROM bank WHERE passage IS NOT NULL)"


@query(f"SELECT row_id, CAST(k AS INT) AS chars, CAST(CASE WHEN k IS NOT NULL THEN instr(p, substr(n, 1, k)) END AS INT) AS at FROM (SELECT *, coalesce(list_filter(range(least(length(n), 30), 9, -1), lambda k: instr(p, substr(n, 1, CAST(k AS INT))) > 0 AND instr(substr(p, instr(p, substr(n, 1, CAST(k AS INT))) + 1), substr(n, 1, CAST(k AS INT))) = 0)[1], list_filter(range(least(length(n), 30), 5, -1), lambda k: instr(p, substr(n, 1, CAST(k AS INT))) > 0)[1]) AS k FROM {_PAGE} x) y")
def join16_located_texts(t):
    """Pieces of passages located again by their longest beginnings."""
    b = t.bank.where("passage is not null").select("row_id", F.col("passage").alias("p"), F.concat(F.substring(tx.squeeze(F.col("passage")), (F.col("row_id") % 40 + 1).cast("int"), F.lit(100_000)), F.lit("x")).alias("n"))
    return b.select("row_id", tx.locate(F.col("p"), F.col("n")).alias("l")).select("row_id", "l.*")


@query("SELECT batch, round(1 - sum(d) / (count(*) * max(d)), 6) AS idle FROM (SELECT CAST(floor(expl_id / 5) AS BIGINT) AS batch, 60.0::DOUBLE + second(merged_at) AS d FROM explanations WHERE merged_at IS NOT NULL) x GROUP BY batch")
def agg21_idle_slots(t):
    """Five slots a batch, each waiting for the slowest."""
    d = 60.0 + F.second("merged_at")
    g = t.explanations.where("merged_at is not null").groupBy(F.floor(F.col("expl_id") / 5).cast("bigint").alias("batch"))
    return g.agg(F.round(1 - F.sum(d) / (F.count("*") * F.max(d)), 6).alias("idle"))


@query("SELECT row_id, CASE answer_status WHEN 'official' THEN ch = answer WHEN 'multi' THEN coalesce(list_contains(accept, ch), FALSE) WHEN 'free' THEN TRUE END AS correct, CASE answer_status WHEN 'official' THEN contains(answer, ch) WHEN 'multi' THEN coalesce(list_contains(accept, ch), FALSE) WHEN 'free' THEN TRUE END AS any_letter FROM (SELECT *, substr('ABCD', CAST(row_id % 4 + 1 AS INT), 1) AS ch FROM bank) x")
def drv04_graded_letters(t):
    """Every question graded for a chosen letter, with both meanings of an answer of several letters."""
    ch = F.substring(F.lit("ABCD"), (F.col("row_id") % 4 + 1).cast("int"), F.lit(1))
    both = [gates.grade(ch, F.col("answer"), F.col("accept"), F.col("answer_status"), s).alias(n) for s, n in (("exact", "correct"), ("any", "any_letter"))]
    return t.bank.select("row_id", *both)


@query("SELECT row_id, CAST(count(*) AS INT) AS cells FROM (SELECT row_id, stem, trim(unnest(string_split(table_md, '|')), ' ' || chr(10)) AS cell FROM bank WHERE table_md IS NOT NULL AND stem IS NOT NULL) x WHERE length(cell) >= 2 AND contains(stem, cell) GROUP BY row_id")
def drv21_leaked_cells(t):
    """Cells of a table that stand in the stem too: candidates, not faults."""
    cells = t.bank.where("table_md is not null and stem is not null").select("row_id", "stem", F.explode(F.split("table_md", r"\|")).alias("c")).withColumn("c", F.btrim("c", F.lit(" \n")))
    return cells.where("length(c) >= 2 and contains(stem, c)").groupBy("row_id").agg(F.count("*").cast("int").alias("cells"))


@query("SELECT store, CAST(sum(len(regexp_extract_all(s, '[。？！]'))) AS BIGINT) AS marks, count(*) AS texts FROM (SELECT 'bank' AS store, stem AS s FROM bank UNION ALL SELECT 'explanations', t FROM explanations UNION ALL SELECT 'documents', text FROM documents UNION ALL SELECT 'proof_stems', stem FROM proof_stems) x WHERE s IS NOT NULL GROUP BY store")
def drv25_all_stores(t):
    stores = {"bank": "stem", "explanations": "t", "documents": "text", "proof_stems": "stem"}
    every = None
    for name, c in stores.items():
        one = getattr(t, name).select(F.lit(name).alias("store"), F.col(c).alias("s"))
        every = one if every is None else every.unionByName(one)
    return every.where("s is not null").groupBy("store").agg(F.sum(F.regexp_count("s", F.lit("[。？！]"))).alias("marks"), F.count("*").alias("texts"))


@query("SELECT event_type, strftime(ts, '%Y-%m') AS month, round(sum(value + 0.1 * coalesce(CAST(json_extract(props, '$.k') AS DOUBLE), 0) + 1.25 * (event_id % 10)), 4) AS cost FROM events WHERE value IS NOT NULL GROUP BY ALL")
def agg22_weighted_cost(t):
    """Cost by kind and month of three classes of size: plain, read again at 10 %, and written at 125 %."""
    k = F.coalesce(F.get_json_object("props", "$.k").cast("double"), F.lit(0.0))
    cost = F.sum(F.col("value") + 0.1 * k + 1.25 * (F.col("event_id") % 10))
    return t.events.where("value is not null").groupBy("event_type", F.date_format("ts", "yyyy-MM").alias("month")).agg(F.round(cost, 4).alias("cost"))
