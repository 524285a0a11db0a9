"""Queries of the DataFrame operators: gates, maintenance, citations, statistics, time and interval joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stemforge.functions import statistics as st
from stemforge.functions import textcols as tx
from stemforge.functions.numerals import article_number, chinese_integer
from stemforge.operators import gates, maintain
from stemforge.operators.citations import citations, impacted, key_numbers_col, plain_name_col, verdicts
from stemforge.operators.orphans import reference_key
from stemforge.operators.ranking import rank_within
from stemforge.operators.snapshots import latest_rows
from stemforge.functions.lookalike import normal_form
from stemforge.plans.change_queries import _KEY, ARTICLE_PARTS, ARTICLE_PLAIN, ARTICLE_SQL, NUMERAL_PART, p3_found, pack_articles, pack_changes
from stemforge.plans.change_queries import SQL as CHANGE_SQL
from stemforge.plans.dual import duck_sql
from stemforge.plans.statements import full_width as _full_width
from stemforge.session import table

CHANGES, FULL_WIDTH = CHANGE_SQL["p3_found"], _full_width("@@")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = duck_sql(sql)
        return f

    return register


def questions(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The latest delivery of each question."""
    bank = table(spark, sf_dir, "bank")
    return latest_rows(bank.select("qid", "loaded_at", "row_id", *[c for c in columns if c not in ("qid", "loaded_at", "row_id")]).where("qid is not null"), ["qid"], ["loaded_at", "row_id"])


@query("agg03_paper_completeness", "WITH n AS (SELECT DISTINCT regexp_extract(qid, '^(.*)_[0-9]+$', 1) AS paper, no FROM {bank} WHERE no IS NOT NULL), g AS (SELECT paper, no, coalesce(lag(no) OVER (PARTITION BY paper ORDER BY no), 0) AS old FROM n WHERE no > 0) SELECT n.paper, count(*) AS rows, max(n.no) AS declared, CAST(coalesce(any_value(x.missing), 0) AS BIGINT) AS missing, coalesce(any_value(x.gaps), '') AS gaps FROM n LEFT JOIN (SELECT paper, sum(no - old - 1) AS missing, string_agg(CASE WHEN no - old = 2 THEN CAST(old + 1 AS VARCHAR) ELSE concat(old + 1, '-', no - 1) END, ',' ORDER BY no) AS gaps FROM g WHERE no - old > 1 GROUP BY paper) x ON n.paper = x.paper GROUP BY n.paper")
def paper_completeness(spark, sf_dir):
    bank = table(spark, sf_dir, "bank").select(gates.paper_of(F.col("qid")).alias("paper"), "no")
    return gates.completeness(bank, "paper", "no")


@query("agg04_share_guard", "SELECT paper, count(*) AS rows, CAST(sum(bad) AS BIGINT) AS bad, sum(bad) > 0.5 * count(*) AS over FROM (SELECT regexp_extract(qid, '^(.*)_[0-9]+$', 1) AS paper, CASE WHEN answer_status IN ('free', 'unread') THEN 1 ELSE 0 END AS bad FROM <q> q) x GROUP BY paper")
def share_guard(spark, sf_dir):
    q = questions(spark, sf_dir, "answer_status").withColumn("paper", gates.paper_of(F.col("qid")))
    return gates.share_guard(q, "paper", F.col("answer_status").isin("free", "unread"))


@query("agg05_option_mode", "SELECT paper, arg_max(n, (k, -n)) AS mode, CAST(sum(k) AS BIGINT) AS rows, max(k) AS conform FROM (SELECT paper, n, count(*) AS k FROM (SELECT regexp_extract(qid, '^(.*)_[0-9]+$', 1) AS paper, CAST(cardinality(options) AS INT) AS n FROM <q> q WHERE type = '單選' AND options IS NOT NULL) y GROUP BY paper, n) x GROUP BY paper")
def option_mode(spark, sf_dir):
    q = questions(spark, sf_dir, "type", "options").where("type = '單選' and options is not null")
    return gates.mode_invariant(q.select(gates.paper_of(F.col("qid")).alias("paper"), F.size("options").alias("n")), "paper", "n")


_FIRST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY loaded_at, row_id) AS k FROM {bank} WHERE answer_src = 'key_pdf') x WHERE k = 1)"


@query("join03_answer_pairing", f"SELECT coalesce(b.qid, k.qid) AS qid, b.answer AS bank_value, k.answer AS key_value, CASE WHEN b.qid IS NULL THEN 'bank_missing' WHEN k.qid IS NULL THEN 'key_missing' WHEN b.answer IS NOT DISTINCT FROM k.answer THEN 'match' ELSE 'mismatch' END AS state FROM <q> b FULL OUTER JOIN {_FIRST} k ON b.qid = k.qid")
def answer_pairing(spark, sf_dir):
    keys = table(spark, sf_dir, "bank").where("answer_src = 'key_pdf' and qid is not null").groupBy("qid").agg(F.min_by("answer", F.struct("loaded_at", "row_id")).alias("answer"))
    return gates.pairing(questions(spark, sf_dir, "answer"), keys, "qid", "answer")


@query("join10_chunk_reconciliation", "SELECT coalesce(i.chunk, o.chunk) AS chunk, count(i.n) AS expected, CAST(sum(CASE WHEN i.n IS NOT NULL AND o.n IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS done, CAST(sum(CASE WHEN o.n IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing, CAST(sum(CASE WHEN i.n IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS foreign, CAST(sum(CASE WHEN o.n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS repeated FROM (SELECT regexp_extract(qid, '^(.*)_[0-9]+$', 1) AS chunk, qid, count(*) AS n FROM <q> q GROUP BY 1, 2) i FULL OUTER JOIN (SELECT regexp_extract(qid, '^(.*)_[0-9]+$', 1) AS chunk, qid, count(*) AS n FROM {explanations} WHERE qid IS NOT NULL GROUP BY 1, 2) o ON i.chunk = o.chunk AND i.qid = o.qid GROUP BY 1")
def chunk_reconciliation(spark, sf_dir):
    a = questions(spark, sf_dir).select("qid", gates.paper_of(F.col("qid")).alias("chunk"))
    b = table(spark, sf_dir, "explanations").where("qid is not null").select("qid", gates.paper_of(F.col("qid")).alias("chunk"))
    return gates.reconcile(a, b, "chunk", "qid")


@query("join11_coverage", "SELECT subject, count(*) AS total, count(e.qid) AS have FROM (SELECT DISTINCT qid, subject FROM {bank} WHERE qid IS NOT NULL) b LEFT JOIN (SELECT DISTINCT qid FROM {explanations} WHERE qid IS NOT NULL AND t IS NOT NULL) e ON b.qid = e.qid GROUP BY subject")
def coverage(spark, sf_dir):
    return gates.coverage(table(spark, sf_dir, "explanations").where("t is not null"), [table(spark, sf_dir, "bank")], "qid", ["subject"])


@query("join17_asof_version", "SELECT e.event_id, e.qid, e.ts, max(b.row_id) AS row_id FROM (SELECT DISTINCT event_id, qid, ts FROM {answer_events} WHERE qid IS NOT NULL) e LEFT JOIN {bank} b ON b.qid = e.qid AND b.loaded_at = (SELECT max(loaded_at) FROM {bank} c WHERE c.qid = e.qid AND c.loaded_at <= e.ts) GROUP BY e.event_id, e.qid, e.ts")
def asof_version(spark, sf_dir):
    """The delivery of a question that each answer was given to."""
    events = table(spark, sf_dir, "answer_events").where("qid is not null").select("event_id", "qid", F.col("ts").alias("at")).distinct()
    bank = table(spark, sf_dir, "bank").select("qid", F.col("loaded_at").alias("at"), "row_id")
    return gates.asof_before(events, bank, "qid", "at", "row_id").withColumnRenamed("at", "ts")


@query("join19_files_alive_by_month", "SELECT month, count(*) AS files FROM (SELECT DISTINCT filename, strftime(unnest(generate_series(date_trunc('month', rendered_at), date_trunc('month', coalesce(deleted_at, TIMESTAMP '2025-12-01')), INTERVAL 1 MONTH)), '%Y-%m') AS month FROM {figure_files} WHERE rendered_at <= coalesce(deleted_at, TIMESTAMP '2025-12-01')) x GROUP BY month")
def files_alive(spark, sf_dir):
    """Interval overlap by buckets: a file's life is cut into months, which are joined by equality."""
    f = table(spark, sf_dir, "figure_files").select("filename", F.col("rendered_at").alias("a"), F.coalesce("deleted_at", F.lit("2025-12-01").cast("timestamp_ntz")).alias("b")).where("a <= b")
    months = f.select("filename", F.explode(F.sequence(F.trunc("a", "month"), F.trunc("b", "month"), F.expr("interval 1 month"))).alias("m"))
    return months.select("filename", F.date_format("m", "yyyy-MM").alias("month")).distinct().groupBy("month").agg(F.count("*").alias("files"))


@query("set02_upsert", f"SELECT coalesce(o.qid, n.qid) AS qid, CASE WHEN n.qid IS NULL THEN o.stem ELSE n.stem END AS stem, CASE WHEN n.qid IS NULL THEN 'kept' WHEN o.qid IS NULL THEN 'added' ELSE 'replaced' END AS state FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY loaded_at DESC, row_id DESC) AS k FROM {{bank}} WHERE loaded_at < TIMESTAMP '2024-07-01') x WHERE k = 1) o FULL OUTER JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY loaded_at DESC, row_id DESC) AS k FROM {{bank}} WHERE loaded_at >= TIMESTAMP '2024-07-01') x WHERE k = 1) n ON o.qid = n.qid")
def upsert(spark, sf_dir):
    bank = table(spark, sf_dir, "bank").select("qid", "stem", "loaded_at", "row_id")
    old = latest_rows(bank.where("loaded_at < timestamp_ntz '2024-07-01'"), ["qid"], ["loaded_at", "row_id"])
    return maintain.upsert(old, bank.where("loaded_at >= timestamp_ntz '2024-07-01'"), "qid", ["loaded_at", "row_id"]).select("qid", "stem", "state")


@query("agg02_upsert_counters", "SELECT state, count(*) AS n FROM (" + SQL["set02_upsert"] + ") u GROUP BY state")
def upsert_counters(spark, sf_dir):
    return upsert(spark, sf_dir).groupBy("state").agg(F.count("*").alias("n"))


@query("set01_partition_replace", "SELECT row_id, subject FROM {bank} WHERE subject IS DISTINCT FROM '國文' UNION ALL SELECT row_id, subject FROM <q> q WHERE subject = '國文'")
def partition_replace(spark, sf_dir):
    bank = table(spark, sf_dir, "bank").select("row_id", "subject")
    return maintain.replace_partition(bank, questions(spark, sf_dir, "subject").select("row_id", "subject"), "subject", "國文")


@query("set05_overlay", "SELECT qid, arg_max(t, (layer, t)) AS t, CAST(max(layer) AS INT) AS layer FROM (SELECT qid, t, CASE c WHEN 'high' THEN 2 WHEN 'med' THEN 1 ELSE 0 END AS layer FROM {explanations} WHERE qid IS NOT NULL AND t IS NOT NULL AND c IN ('low', 'med', 'high')) x GROUP BY qid")
def overlay(spark, sf_dir):
    e = table(spark, sf_dir, "explanations").select("qid", "t", "c")
    return maintain.overlay([e.where(f"c = '{c}'") for c in ("low", "med", "high")], "qid", "t")


@query("set06_splice", "SELECT expl_id, array_to_string(list_concat(list_slice(string_split(t, chr(10) || chr(10)), 1, 1), ['（略）'], list_slice(string_split(t, chr(10) || chr(10)), 3, 100000)), chr(10) || chr(10)) AS spliced FROM {explanations} WHERE t IS NOT NULL AND len(string_split(t, chr(10) || chr(10))) >= 2 UNION ALL SELECT expl_id, t FROM {explanations} WHERE t IS NOT NULL AND len(string_split(t, chr(10) || chr(10))) < 2")
def splice(spark, sf_dir):
    return table(spark, sf_dir, "explanations").where("t is not null").select("expl_id", maintain.splice(F.col("t"), F.lit(2), F.lit("（略）")).alias("spliced"))


@query("prd09_letter_coverage", "SELECT qid, array_to_string(list_sort(list_filter(map_keys(options), lambda x: x <> answer)), '') AS wrong FROM <q> q WHERE type = '單選' AND options IS NOT NULL AND length(answer) = 1")
def letter_coverage(spark, sf_dir):
    """The letters that each single-choice explanation has to discuss; prd09_letter_faults is the check."""
    q = questions(spark, sf_dir, "type", "options", "answer").where("type = '單選' and options is not null and length(answer) = 1")
    return q.select("qid", F.array_join(tx.wrong_letters(F.col("options"), F.col("answer")), "").alias("wrong"))


# Types without options.
FREE_TYPES = ("非選", "選填", "申論", "計算")
_SQL_KEY = _KEY.replace("@@", "qid")
_SQL_LETTERS = "array_to_string(list_sort(list_filter({0}, lambda x: {1})), '')"
_FAULTS = f"""WITH q AS (
  SELECT k, type, translate(coalesce(answer, ''), '{tx.LETTERS_SEEN}', '{tx.LETTERS}') AS answer, coalesce(map_keys(options), []) AS opts FROM (
    SELECT *, {_SQL_KEY} AS k, row_number() OVER (PARTITION BY {_SQL_KEY} ORDER BY loaded_at DESC, row_id DESC) AS n FROM bank) x WHERE n = 1 AND k IS NOT NULL),
e AS (
  SELECT expl_id, qid, {_SQL_KEY} AS k, list_distinct(list_transform(regexp_extract_all(regexp_replace(regexp_replace(translate(t, '{tx.LETTERS_SEEN}', '{tx.LETTERS}'),
    '^[ 　\\r\\n]*[^\\r\\n]+', ''), '[\\r\\n][ 　\\r\\n]*本題考點[：:][\\s\\S]*$', ''), '{tx.DISCUSSED}', 1), lambda x: regexp_replace(x, '[^A-J]', '', 'g'))) AS seen
  FROM explanations WHERE t IS NOT NULL),
j AS (
  SELECT e.*, q.k AS found, q.type, q.opts, list_distinct(regexp_extract_all(q.answer, '[A-J]')) AS ans FROM e LEFT JOIN q ON e.k = q.k),
f AS (
  SELECT expl_id, qid, CASE WHEN found IS NULL THEN 'no_question' WHEN len(opts) = 0 THEN 'no_options' WHEN len(ans) = 0 THEN 'no_answer' ELSE 'letters' END AS fault,
    {_SQL_LETTERS.format("opts", "NOT list_contains(ans, x) AND NOT list_contains(seen, x)")} AS missing,
    {_SQL_LETTERS.format("seen", "NOT (list_contains(opts, x) AND NOT list_contains(ans, x)) AND NOT (len(ans) > 1 AND list_contains(ans, x))")} AS stray
  FROM j WHERE found IS NULL OR len(opts) > 0 OR coalesce(type, '') NOT IN {FREE_TYPES})
SELECT expl_id, qid, fault, CASE WHEN fault = 'letters' THEN missing END AS missing, CASE WHEN fault = 'letters' THEN stray END AS stray FROM f WHERE fault <> 'letters' OR missing <> '' OR stray <> ''"""


@query("prd09_letter_faults")
def letter_faults(spark, sf_dir):
    """Explanations whose body doesn't discuss the letters it has to: one answer, exactly the wrong options; several, all wrong options and else only answers.

    A question that isn't there, has no options (unless its type has none either) or no answer is a fault of its own. Null texts are join11_coverage's.
    """
    bank = table(spark, sf_dir, "bank").select(reference_key(F.col("qid")).alias("k"), "type", "options", "answer", "loaded_at", "row_id").where("k is not null")
    q = latest_rows(bank, ["k"], ["loaded_at", "row_id"]).select("k", "type", F.coalesce(F.map_keys("options"), F.array().cast("array<string>")).alias("opts"), tx.answer_letters(F.translate("answer", tx.LETTERS_SEEN, tx.LETTERS)).alias("ans"), F.lit(True).alias("found"))
    e = table(spark, sf_dir, "explanations").where("t is not null").select("expl_id", "qid", reference_key(F.col("qid")).alias("k"), tx.discussed_letters(tx.explanation_body(F.col("t"))).alias("seen"))
    wrong, ans = F.array_except("opts", "ans"), F.array_distinct("ans")
    allowed = F.when(F.size(ans) > 1, F.concat(wrong, ans)).otherwise(wrong)
    letters = lambda x: F.array_join(F.array_sort(x), "")
    fault = F.when(F.col("found").isNull(), "no_question").when(F.size("opts") == 0, "no_options").when(F.size("ans") == 0, "no_answer").otherwise("letters")
    j = e.join(q, "k", "left").where(F.col("found").isNull() | (F.size("opts") > 0) | ~F.coalesce("type", F.lit("")).isin(*FREE_TYPES))
    own = lambda x: F.when(F.col("fault") == "letters", letters(x))
    return j.withColumn("fault", fault).select("expl_id", "qid", "fault", own(F.array_except(wrong, "seen")).alias("missing"), own(F.array_except("seen", allowed)).alias("stray")).where("fault <> 'letters' or missing <> '' or stray <> ''")


SQL["prd09_letter_faults"] = _FAULTS


@query("drv05_illegal_letters", "SELECT qid, answer FROM <q> q WHERE answer IS NOT NULL AND rl(answer, '^[A-J]+$') AND options IS NOT NULL AND cardinality(options) > 0 AND len(list_filter(string_split(answer, ''), lambda x: x <> '' AND NOT list_contains(map_keys(options), x))) > 0")
def illegal_letters(spark, sf_dir):
    q = questions(spark, sf_dir, "options", "answer").where("answer rlike '^[A-J]+$' and size(options) > 0")
    return q.where(F.size(F.array_except(tx.answer_letters(F.col("answer")), F.map_keys("options"))) > 0).select("qid", "answer")


@query("prd18_marks_in_order", "SELECT row_id FROM {bank} WHERE options IS NOT NULL AND cardinality(options) > 0 AND array_to_string(map_keys(options), '') <> substr('ABCDEFGHIJ', 1, CAST(cardinality(options) AS INT))")
def marks_in_order(spark, sf_dir):
    """Option marks in the order they are stored in."""
    return table(spark, sf_dir, "bank").where("size(options) > 0").where(~tx.marks_in_order(F.map_keys("options"))).select("row_id")


@query("prd21_long_options", "SELECT row_id, letter, CAST(length(text) AS INT) AS n FROM (SELECT row_id, unnest(map_keys(options)) AS letter, unnest(map_values(options)) AS text FROM {bank}) x WHERE length(text) > 200 OR trim(text) = ''")
def long_options(spark, sf_dir):
    o = table(spark, sf_dir, "bank").select("row_id", F.explode("options").alias("letter", "text"))
    return o.where("length(text) > 200 or trim(text) = ''").select("row_id", "letter", F.length("text").alias("n"))


@query("prd14_equal_options", "SELECT row_id FROM (SELECT row_id, unnest(map_values(options)) AS text FROM {bank}) x WHERE text <> '' GROUP BY row_id HAVING count(*) > count(DISTINCT text)")
def equal_options(spark, sf_dir):
    values = F.filter(F.map_values("options"), lambda v: v != "")
    return table(spark, sf_dir, "bank").where(F.size(values) > F.size(F.array_distinct(values))).select("row_id")


@query("set07_option_letters", "SELECT letter, count(*) AS n FROM (SELECT unnest(map_keys(options)) AS letter FROM {bank}) x GROUP BY letter")
def option_letters(spark, sf_dir):
    return table(spark, sf_dir, "bank").select(F.explode(F.map_keys("options")).alias("letter")).groupBy("letter").agg(F.count("*").alias("n"))


@query("nrm16_article_numbers", "SELECT DISTINCT k AS spelt, rr(rr(rr(translate(k, '０１２３４５６７８９－', '0123456789-'), '^第', ''), '條', ''), '之', '-') AS art FROM (SELECT unnest(map_keys(articles)) AS k FROM {anchor_packs}) x")
def article_numbers(spark, sf_dir):
    keys = table(spark, sf_dir, "anchor_packs").select(F.explode(F.map_keys("articles")).alias("spelt")).distinct()
    return keys.select("spelt", article_number(F.col("spelt")).alias("art"))


_TOKEN = "[零〇一二兩三四五六七八九十百千萬]+"
_VALUE = "CASE WHEN contains(token, '萬') THEN CAST(" + NUMERAL_PART.format("split_part(token, '萬', 1)") + " AS BIGINT) * 10000 + coalesce(TRY_CAST(" + NUMERAL_PART.format("split_part(token, '萬', 2)") + " AS BIGINT), 0) ELSE CAST(" + NUMERAL_PART.format("token") + " AS BIGINT) END"


@query("nrm13_numerals", "SELECT token, n, " + _VALUE + " AS value FROM (SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '" + _TOKEN + "')) AS token FROM (SELECT unnest(map_values(articles)) AS text FROM anchor_packs) x) y WHERE len(regexp_extract_all(token, '萬')) <= 1 AND NOT starts_with(token, '萬') GROUP BY token) z")
def numerals(spark, sf_dir):
    """The numerals of all article texts, and their values."""
    text = table(spark, sf_dir, "anchor_packs").select(F.explode(F.map_values("articles")).alias("text"))
    tokens = text.select(F.explode(F.regexp_extract_all("text", F.lit(f"({_TOKEN})"), 1)).alias("token")).where("regexp_count(token, '萬') <= 1 and not startswith(token, '萬')")
    return tokens.groupBy("token").agg(F.count("*").alias("n")).select("token", "n", chinese_integer(F.col("token")).alias("value"))


@query("win02_chain_stack", "SELECT qid, CAST(count(*) OVER (PARTITION BY group_id ORDER BY no, qid ROWS BETWEEN 9 PRECEDING AND 1 PRECEDING) AS BIGINT) AS before_n, coalesce(string_agg(qid, '|') OVER (PARTITION BY group_id ORDER BY no, qid ROWS BETWEEN 9 PRECEDING AND 1 PRECEDING), '') AS before FROM <q> q WHERE group_id IS NOT NULL")
def chain_stack(spark, sf_dir):
    w = Window.partitionBy("group_id").orderBy("no", "qid").rowsBetween(1 - gates.GROUP_SPAN, -1)  # a group has no more
    return questions(spark, sf_dir, "group_id", "no").where("group_id is not null").select("qid", F.count("*").over(w).alias("before_n"), F.array_join(F.collect_list("qid").over(w), "|").alias("before"))


@query("win04_review_insertion", "SELECT event_id, user_id, right_so_far FROM (SELECT event_id, user_id, correct, CAST(sum(CASE WHEN correct THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS right_so_far FROM (SELECT DISTINCT event_id, user_id, ts, correct FROM {answer_events}) d) x WHERE correct AND right_so_far % 5 = 0")
def review_insertion(spark, sf_dir):
    """A review is due after every fifth right answer. Running sums by day first, so that a user with many rows is spread over tasks."""
    e = table(spark, sf_dir, "answer_events").select("event_id", "user_id", "ts", "correct").distinct().withColumn("day", F.to_date("ts"))
    one = F.when(F.col("correct"), 1).otherwise(0)
    days = e.groupBy("user_id", "day").agg(F.sum(one).alias("n"))
    base = days.select("user_id", "day", F.coalesce(F.sum("n").over(Window.partitionBy("user_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = F.sum(one).over(Window.partitionBy("user_id", "day").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0))
    e = e.withColumn("inside", inside).join(base, ["user_id", "day"])
    return e.withColumn("right_so_far", (F.col("base") + F.col("inside")).cast("bigint")).where("correct and right_so_far % 5 = 0").select("event_id", "user_id", "right_so_far")


@query("agg19_extreme_breaker", "SELECT qid, count(*) AS n, CAST(sum(CASE WHEN correct THEN 1 ELSE 0 END) AS BIGINT) AS hits, count(*) >= 10 AND (sum(CASE WHEN correct THEN 1 ELSE 0 END) = 0 OR sum(CASE WHEN correct THEN 1 ELSE 0 END) = count(*)) AS tripped FROM {answer_events} WHERE qid IS NOT NULL AND correct IS NOT NULL GROUP BY qid")
def extreme_breaker(spark, sf_dir):
    return gates.breaker(table(spark, sf_dir, "answer_events").where("qid is not null and correct is not null"), "qid", F.col("correct"), least=10)


_LOG = "(lgamma(n1 + 1) - lgamma({0} + 1) - lgamma(n1 - {0} + 1) + lgamma(n2 + 1) - lgamma(a + b - {0} + 1) - lgamma(n2 - a - b + {0} + 1) - lgamma(n1 + n2 + 1) + lgamma(a + b + 1) + lgamma(n1 + n2 - a - b + 1))"


@query("agg14_fisher", f"SELECT subject, a, n1, b, n2, round(list_sum(list_transform(list_filter(range(greatest(0, a + b - n2), least(n1, a + b) + 1), lambda x: {_LOG.format('x')} <= {_LOG.format('a')} + 1e-7), lambda x: exp({_LOG.format('x')}))), 6) AS p FROM (SELECT subject, count(*) FILTER (no % 2 = 0 AND parse = 'review') AS a, count(*) FILTER (no % 2 = 0) AS n1, count(*) FILTER (no % 2 = 1 AND parse = 'review') AS b, count(*) FILTER (no % 2 = 1) AS n2 FROM <q> q WHERE no IS NOT NULL GROUP BY subject) x")
def fisher(spark, sf_dir):
    """Whether even and odd questions of a subject need review at different rates."""
    q = questions(spark, sf_dir, "subject", "no", "parse").where("no is not null")
    odd, bad = F.col("no") % 2 == 1, F.col("parse") == "review"
    t = q.groupBy("subject").agg(F.count_if(~odd & bad).alias("a"), F.count_if(~odd).alias("n1"), F.count_if(odd & bad).alias("b"), F.count_if(odd).alias("n2"))
    return t.select("*", F.round(st.fisher(F.col("a"), F.col("n1"), F.col("b"), F.col("n2")), 6).alias("p"))


_TAIL = "round(least(1.0, 2 * list_sum(list_transform(range(0, CAST(least({a}, {b}) AS BIGINT) + 1), lambda i: exp(lgamma({a} + {b} + 1) - lgamma(i + 1) - lgamma({a} + {b} - i + 1) - ({a} + {b}) * ln(2.0))))), 5)"


@query("agg16_sign_test", "SELECT subject, wins, losses, " + _TAIL.replace("{a}", "wins").replace("{b}", "losses") + " AS p FROM (SELECT q.subject, count(*) FILTER (e.c = 'high') AS wins, count(*) FILTER (e.c = 'low') AS losses FROM <q> q JOIN explanations e ON e.qid = q.qid GROUP BY q.subject) x")
def sign_test(spark, sf_dir):
    """High against low levels of a subject's explanations."""
    e = table(spark, sf_dir, "explanations").select("qid", "c").join(questions(spark, sf_dir, "subject").select("qid", "subject"), "qid")
    t = e.groupBy("subject").agg(F.count_if(F.col("c") == "high").alias("wins"), F.count_if(F.col("c") == "low").alias("losses"))
    return t.select("*", F.round(st.binomial_two_sided(F.col("wins"), F.col("wins") + F.col("losses")), 5).alias("p"))


@query("agg15_mcnemar", "SELECT subject, b, c, " + _TAIL.replace("{a}", "b").replace("{b}", "c") + " AS p FROM (SELECT q.subject, CAST(sum(CASE WHEN e.x = 1 AND e.y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS b, CAST(sum(CASE WHEN e.x = 0 AND e.y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS c FROM (SELECT qid, max(CASE WHEN user_id % 2 = 0 AND correct THEN 1 ELSE 0 END) AS x, max(CASE WHEN user_id % 2 = 1 AND correct THEN 1 ELSE 0 END) AS y FROM {answer_events} WHERE qid IS NOT NULL GROUP BY qid) e JOIN <q> q ON e.qid = q.qid GROUP BY q.subject) z")
def mcnemar(spark, sf_dir):
    hit = lambda r: F.max(F.when((F.col("user_id") % 2 == r) & F.col("correct"), 1).otherwise(0))
    per = table(spark, sf_dir, "answer_events").where("qid is not null").groupBy("qid").agg(hit(0).alias("x"), hit(1).alias("y"))
    t = per.join(questions(spark, sf_dir, "subject").select("qid", "subject"), "qid").groupBy("subject").agg(F.count_if((F.col("x") == 1) & (F.col("y") == 0)).alias("b"), F.count_if((F.col("x") == 0) & (F.col("y") == 1)).alias("c"))
    return t.select("*", F.round(st.binomial_two_sided(F.col("b"), F.col("b") + F.col("c")), 5).alias("p"))


@query("dup01_content_fingerprint", "SELECT row_id, sha256(rr(stem, '[ 　\r\n]+', '') || chr(1) || array_to_string(list_sort(list_transform(coalesce(map_values(options), []), lambda o: rr(coalesce(o, ''), '[ 　\r\n]+', ''))), chr(1))) AS fp FROM {bank} WHERE stem IS NOT NULL")
def content_fingerprint(spark, sf_dir):
    return table(spark, sf_dir, "bank").where("stem is not null").select("row_id", tx.content_fingerprint(F.col("stem"), F.col("options")).alias("fp"))


@query("agg23_token_conservation", "SELECT a.expl_id, CAST(len(list_filter(list_distinct(regexp_extract_all(a.t, '[0-9]+')), lambda x: NOT list_contains(regexp_extract_all(b.t, '[0-9]+'), x))) AS BIGINT) AS lost, CAST(len(list_filter(list_distinct(regexp_extract_all(b.t, '[0-9]+')), lambda x: NOT list_contains(regexp_extract_all(a.t, '[0-9]+'), x))) AS BIGINT) AS added FROM (SELECT *, lead(expl_id) OVER (PARTITION BY qid ORDER BY merged_at, expl_id) AS nxt FROM {explanations} WHERE t IS NOT NULL AND qid IS NOT NULL) a JOIN {explanations} b ON a.nxt = b.expl_id")
def token_conservation(spark, sf_dir):
    """Numbers that a text's next version lost or added. Versions are numbered in cells of months and meet by number, so one qid may have any share of the rows."""
    e = table(spark, sf_dir, "explanations").where("t is not null and qid is not null").select("expl_id", "qid", "merged_at", F.regexp_extract_all("t", F.lit("([0-9]+)"), 1).alias("numbers"))
    k = rank_within(e, ["qid"], F.trunc("merged_at", "month"), [F.asc_nulls_first("merged_at"), "expl_id"], "k")
    e = k.select("expl_id", "qid", "k", F.col("numbers").alias("t")).join(k.select("qid", (F.col("k") - 1).alias("k"), F.col("numbers").alias("u")), ["qid", "k"])
    old, new = F.col("t"), F.col("u")
    return e.select("expl_id", F.size(F.array_except(old, new)).cast("bigint").alias("lost"), F.size(F.array_except(new, old)).cast("bigint").alias("added"))


def _newest_articles(packs):
    """(law, art, numbers, pcode) of the newest pack of each law."""
    latest = latest_rows(packs.where("pcode is not null").select("pcode", "pack_date", "loaded_at", "pack_row"), ["pcode"], ["pack_date", "loaded_at", "pack_row"]).select("pack_row")
    own = packs.join(latest, "pack_row", "left_semi").select("pcode", plain_name_col(F.col("law")).alias("law"), F.explode("articles").alias("k", "text"))
    return own.select("pcode", "law", article_number(F.col("k")).alias("art"), key_numbers_col(F.col("text")).alias("numbers"))


@query("join05_citation_verdicts")
def citation_verdicts(spark, sf_dir):
    """Citations in documents and explanations, checked against the articles of the newest packs."""
    packs = table(spark, sf_dir, "anchor_packs")
    laws = [r["law"] for r in packs.select(plain_name_col(F.col("law")).alias("law")).where("law <> ''").distinct().collect()]
    text = table(spark, sf_dir, "documents").select(F.lit("documents").alias("src_table"), F.col("doc_id").alias("src_id"), "text")
    text = text.unionByName(table(spark, sf_dir, "explanations").select(F.lit("explanations").alias("src_table"), F.col("expl_id").alias("src_id"), F.col("t").alias("text")))
    found = text.where("text is not null").select("src_table", "src_id", F.explode(citations(F.col("text"), laws)).alias("c")).select("src_table", "src_id", "c.*")
    return verdicts(found, _newest_articles(packs).drop("pcode")).groupBy("law", "status").agg(F.count("*").alias("refs"))


_OLD = """WITH p AS (SELECT *, row_number() OVER (PARTITION BY pcode ORDER BY pack_date DESC, loaded_at DESC, pack_row DESC) AS k FROM anchor_packs WHERE pcode IS NOT NULL),
valid AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pack_date, pcode ORDER BY loaded_at DESC, pack_row DESC) AS v FROM p WHERE pack_date IS NOT NULL) x WHERE v = 1),
spelt AS (SELECT pcode, pack_date, k, e.key AS spelt, e.value AS text FROM (SELECT pcode, pack_date, k, unnest(map_entries(articles)) AS e FROM {0}) x),
arts AS (SELECT pcode, pack_date, """ + ARTICLE_SQL + """ AS art FROM (SELECT *, """ + ARTICLE_PARTS + """ FROM (SELECT *, """ + ARTICLE_PLAIN + """ AS s FROM spelt) a) b)"""


@query("join05_pack_citations", "SELECT o.pack_date, CASE WHEN n.art IS NULL THEN 'fail' ELSE 'there' END AS status, count(*) AS refs FROM (" + _OLD.replace("{0}", "valid") + " SELECT DISTINCT pcode, pack_date, art FROM arts) o LEFT JOIN (" + _OLD.replace("{0}", "(SELECT * FROM p WHERE k = 1) w") + " SELECT DISTINCT pcode, art FROM arts) n ON o.pcode = n.pcode AND o.art = n.art GROUP BY ALL")
def pack_citations(spark, sf_dir):
    """Every article of every pack cited in a sentence with its law's code as the name, read back from the text, and looked up in the newest pack; numbers are join05_number_flags'."""
    return _pack_verdicts(spark, sf_dir).groupBy("pack_date", F.when(F.col("status").isin("ok", "flag"), "there").otherwise(F.col("status")).alias("status")).agg(F.count("*").alias("refs"))


@query("agg07_citation_summary", "SELECT pack_date, CAST(sum(refs) AS BIGINT) AS refs, CAST(sum(CASE WHEN status = 'fail' THEN refs ELSE 0 END) AS BIGINT) AS fail FROM (" + SQL["join05_pack_citations"] + ") s GROUP BY pack_date")
def citation_summary(spark, sf_dir):
    """How many citations could be seen at all, and how many failed."""
    return _pack_verdicts(spark, sf_dir).groupBy("pack_date").agg(F.count("*").alias("refs"), F.count_if(F.col("status") == "fail").alias("fail"))


@query("join05_number_flags")
def number_flags(spark, sf_dir):
    """Of those citations, the ones whose numbers the newest article doesn't have."""
    return _pack_verdicts(spark, sf_dir).where("status = 'flag'").select("pack_date", "law", "art", "note")


def _pack_verdicts(spark, sf_dir):
    packs = table(spark, sf_dir, "anchor_packs")
    law = F.concat(F.lit("法典"), "pcode")
    said = F.concat(law, F.lit("第"), F.regexp_replace("art", "-", "條之"), F.when(F.contains("art", F.lit("-")), "：").otherwise("條："), F.regexp_replace(F.coalesce("text", F.lit("")), "[。！？!?；;\n]", "，"))
    text = pack_articles(packs).select("pack_date", "pcode", said.alias("t"))
    laws = [f"法典{r['pcode']}" for r in packs.where("pcode is not null").select("pcode").distinct().collect()]
    found = text.select("pack_date", F.get(citations(F.col("t"), laws), 0).alias("c")).select("pack_date", "c.*")
    newest = _newest_articles(packs).select(law.alias("law"), "art", "numbers")
    return verdicts(found, newest)


@query("join07_impacted_laws")
def impacted_laws(spark, sf_dir):
    """Documents and explanations that cite an article which a pack changed, with the kinds of change and the articles."""
    packs = table(spark, sf_dir, "anchor_packs")
    names = packs.where("pcode is not null and law is not null").select(plain_name_col(F.col("law")).alias("law"), "pcode").where("law <> ''").distinct()
    laws = [r["law"] for r in names.select("law").distinct().collect()]
    text = table(spark, sf_dir, "documents").select(F.lit("documents").alias("src_table"), F.col("doc_id").alias("src_id"), "text")
    text = text.unionByName(table(spark, sf_dir, "explanations").select(F.lit("explanations").alias("src_table"), F.col("expl_id").alias("src_id"), F.col("t").alias("text")))
    cited = text.where("text is not null").select("src_table", "src_id", F.explode(citations(F.col("text"), laws)).alias("c")).select("src_table", "src_id", "c.law", "c.art")
    return impacted(cited, names, pack_changes(packs).where("art <> ''"))


@query("agg08_impact_summary", "SELECT pack_date, count(*) FILTER (change_type = 'added') AS added, count(*) FILTER (change_type = 'amended') AS amended, count(*) FILTER (change_type = 'removed') AS removed, count(DISTINCT pcode) AS laws FROM (" + CHANGES + ") c WHERE change_type <> 'amend_date' GROUP BY pack_date")
def impact_summary(spark, sf_dir):
    """Articles touched by each pack, by kind, and the laws they are of."""
    n = p3_found(spark, sf_dir).where("change_type <> 'amend_date'")
    kinds = [F.count_if(F.col("change_type") == k).alias(k) for k in ("added", "amended", "removed")]
    return n.groupBy("pack_date").agg(*kinds, F.countDistinct("pcode").alias("laws"))


@query("nrm05_article_lengths", "SELECT pack_row, art, CAST(length(regexp_replace(arg_min(nfc_normalize(text), spelt), '[\\s\\p{Z}]+', '', 'g')) AS INT) AS n FROM (SELECT *, " + ARTICLE_SQL + " AS art FROM (SELECT *, " + ARTICLE_PARTS + " FROM (SELECT *, " + ARTICLE_PLAIN + " AS s FROM (SELECT pack_row, e.key AS spelt, e.value AS text FROM (SELECT pack_row, unnest(map_entries(articles)) AS e FROM (SELECT *, row_number() OVER (PARTITION BY pack_date, pcode ORDER BY loaded_at DESC, pack_row DESC) AS v FROM anchor_packs WHERE pcode IS NOT NULL AND pack_date IS NOT NULL) p WHERE v = 1) x) y) a) b) c WHERE text IS NOT NULL GROUP BY pack_row, art")
def article_lengths(spark, sf_dir):
    """Articles of the valid packs with their length in composed form without blanks."""
    text = normal_form(F.col("text"), F.lit("NFC"))
    return pack_articles(table(spark, sf_dir, "anchor_packs")).where("text is not null").select("pack_row", "art", F.length(tx.squeeze(text)).alias("n"))


@query("nrm08_full_width_marks", "SELECT * FROM (SELECT doc_id, " + FULL_WIDTH.replace("@@", "text") + " AS fixed, text FROM documents) x WHERE fixed <> text")
def full_width_marks(spark, sf_dir):
    """Documents whose half-width marks after ideographs become full-width."""
    fixed = tx.full_width_marks(F.col("text"))
    return table(spark, sf_dir, "documents").where(fixed != F.col("text")).select("doc_id", fixed.alias("fixed"), "text")


_WIDE = "[\\x{3000}-\\x{303f}\\x{3400}-\\x{4dbf}\\x{4e00}-\\x{9fff}\\x{ff00}-\\x{ffef}]"


@query("nrm06_joined_stems", f"SELECT row_id, trim(regexp_replace(regexp_replace(regexp_replace(stem, '[\\s\\p{{Z}}\\x{{85}}\\x{{b}}]+', ' ', 'g'), '({_WIDE}) ({_WIDE})', '\\1\\2', 'g'), '({_WIDE}) ({_WIDE})', '\\1\\2', 'g'), ' ') AS stem FROM bank WHERE stem IS NOT NULL")
def joined_stems(spark, sf_dir):
    """Stems on one line, without blanks between wide characters."""
    return table(spark, sf_dir, "bank").where("stem is not null").select("row_id", tx.join_clean(F.col("stem")).alias("stem"))
