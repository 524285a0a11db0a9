"""Queries of the text rules, gates, joins and windows by DataFrame operators; ``statements`` has the SQL that checks them, written apart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stemforge.functions import statistics as st
from stemforge.functions import textcols as tx
from stemforge.operators import gates, maintain
from stemforge.operators.ranking import rank_within
from stemforge.operators.snapshots import latest_rows
from stemforge.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


class Tables:
    """The tables of a folder by name; ``q`` is the latest delivery of each question."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def q(self, *columns: str) -> DataFrame:
        return self._pick(columns, latest_rows)

    def first(self, *columns: str) -> DataFrame:
        """The first delivery of each question."""
        return self._pick(columns, lambda df, by, order: df.groupBy(*by).agg(F.min_by(F.struct(*[c for c in df.columns if c not in by]), F.struct(*order)).alias("_r")).select(*by, "_r.*"))

    def _pick(self, columns: tuple[str, ...], pick: Callable) -> DataFrame:
        return pick(self.bank.select("qid", "loaded_at", "row_id", *[c for c in columns if c not in ("qid", "loaded_at", "row_id")]), ["qid"], ["loaded_at", "row_id"])


def query(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
    return f


def n_if(c: Column, name: str) -> Column:
    return F.count_if(c).alias(name)


rows_ = lambda name="n": F.count(F.lit(1)).alias(name)


# --- normalisation and character classes


@query
def nrm04_squeezed_length(t):
    return t.bank.where("stem is not null").select("row_id", F.length(tx.squeeze(F.col("stem"))).cast("bigint").alias("n"))


@query
def nrm07_answer_width(t):
    return t.bank.where("answer is not null").select("row_id", tx.fold_answer(F.col("answer")).alias("answer_key"))


@query
def nrm18_roc_years(t):
    return t.bank.where("year is not null").select("row_id", "year", F.year(tx.roc_date(F.format_string("民國 %d 年 1 月 1 日", "year"))).cast("bigint").alias("ce_year"))


@query
def nrm19_safe_names(t):
    return t.anchor_packs.select("pack_row", tx.safe_name(F.col("law")).alias("safe"))


@query
def nrm11_line_ends(t):
    return t.explanations.where("t is not null").select("expl_id", tx.tidy_gates(F.col("t")).alias("t"))


@query
def nrm20_visible_text(t):
    html = F.concat(F.lit("<div><script>x<y</script><p>"), "t", F.lit("</p>&amp;<br/>&lt;end&gt;</div>"))
    return t.explanations.where("t is not null and not contains(t, '<') and not contains(t, '&')").select("expl_id", tx.visible_text(html).alias("text"))


@query
def nrm23_term_mapping(t):
    terms = {"medium": "med", "MED": "med", "HIGH": "high", "LOW": "low"}
    return t.explanations.select("expl_id", tx.map_terms(F.col("c"), terms).alias("c"))


@query
def nrm24_text_digest(t):
    return t.documents.where("text is not null").select("doc_id", tx.prompt_digest(F.col("text"), "HB-CORE").alias("digest"))


# --- predicates and lint


@query
def prd01_furniture_lines(t):
    dropped = F.size(F.filter(F.split("stem", "\n"), tx.furniture_line)).cast("bigint")
    return t.bank.where("stem is not null").select("row_id", dropped.alias("dropped"), tx.without_furniture(F.col("stem")).alias("text"))


@query
def prd03_figure_flag(t):
    need = tx.needs_figure(F.col("stem"), F.col("passage"), F.col("options"))
    return t.q("stem", "passage", "options", "needs_figure").select("qid", F.coalesce(need, F.lit(False)).alias("needs"), "needs_figure")


@query
def prd07_anomalous_signs(t):
    """Every string of a row that is text, nested ones too; keys and ids aren't."""
    texts = F.concat_ws("\u0001", "stem", "passage", F.array_join(F.map_values("options"), "\u0001"), "table_md")
    return t.bank.select("row_id", tx.anomalous_signs(texts).cast("bigint").alias("signs")).where("signs > 0")


@query
def prd08_structure(t):
    return t.explanations.where("t is not null").select("expl_id", F.array_join(tx.structure_faults(F.col("t")), ",").alias("faults")).where("faults <> ''")


@query
def prd10_conclusion(t):
    said = tx.concluded_letters(F.col("t"))
    e = t.explanations.where("t is not null").select("expl_id", "qid", said.alias("said")).where("said <> ''")
    return e.join(t.q("answer").select("qid", "answer").where("answer is not null"), "qid").where(F.col("said") != tx.fold_answer(F.col("answer"))).select("expl_id", "answer", "said")


@query
def prd11_boilerplate(t):
    return t.explanations.where(F.col("t").rlike(tx.BOILERPLATE)).select("expl_id", tx.without_boilerplate(F.col("t")).alias("t"))


@query
def prd13_half_marks(t):
    return t.bank.select("row_id", tx.half_marks_beside_han(F.col("stem")).cast("bigint").alias("marks")).where("marks > 0")


@query
def prd15_repeated_marks(t):
    return t.bank.where(tx.repeated_mark(F.col("stem"))).select("row_id")


@query
def prd16_open_stems(t):
    return t.q("stem").where(F.col("stem").isNotNull() & ~tx.ends_like_sentence(F.col("stem"))).select("row_id")


@query
def prd17_text_after_mark(t):
    return t.q("stem").where(tx.text_after_question(F.col("stem"))).select("row_id")


@query
def prd19_quote_balance(t):
    return t.bank.select("row_id", F.explode("options").alias("letter", "o")).where(~tx.quotes_balance(F.col("o"))).select("row_id", "letter")


@query
def prd25_follow_ups(t):
    return t.bank.where(F.col("stem").rlike(tx.FOLLOW_UP_WORDS)).select("row_id", "standalone")


@query
def prd27_answerable(t):
    ok = F.col("answer_status").isin(*gates.ANSWERABLE)
    return t.q("subject", "answer_status").groupBy("subject").agg(rows_("rows"), n_if(ok, "answerable"))


@query
def prd28_status_domain(t):
    status = F.col("answer_status")
    return t.bank.groupBy(F.coalesce(status, F.lit("(none)")).alias("status")).agg(rows_(), n_if(status.isin(*gates.READ_ONLY) & F.col("answer").rlike("^[A-J]+$"), "legal_looking"))


@query
def prd34_negative_stems(t):
    return t.bank.where(F.col("stem").rlike(tx.NEGATIVE_WORDS)).select("row_id")


@query
def prd26_audit_gaps(t):
    gaps = {"no_answer": F.coalesce(F.col("answer"), F.lit("")) == "", "no_source": F.col("answer_src").isNull(), "no_stem": F.col("stem").isNull(), "no_subject": F.col("subject").isNull()}
    codes = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in gaps.items()]))
    return t.q("answer", "answer_src", "stem", "subject").select("qid", F.array_join(codes, ",").alias("gaps")).where("gaps <> ''")


@query
def drv10_masked_marks(t):
    """A stem whose marks are masked equals another stem's: only the marks differ."""
    masked = F.regexp_replace("stem", "[①-⑩]", "○")
    m = t.bank.where(F.col("stem").rlike("[①-⑩]")).select("row_id", "stem", masked.alias("masked"))
    return m.groupBy("masked").agg(F.min("row_id").alias("lead_row"), rows_("rows"), F.countDistinct("stem").alias("stems"))


@query
def drv22_digit_tails(t):
    return t.bank.where("figure is not null").where(F.regexp_count(F.right("stem", F.lit(30)), F.lit("[0-9]")) >= 5).select("row_id")


@query
def drv11_control_group(t):
    odd = F.regexp_extract("stem", "([攺攄堍碓宄])", 1)
    o = t.bank.where("stem is not null").select("row_id", "subject", odd.alias("odd")).where("odd <> ''")
    n = o.groupBy(F.col("subject").alias("s"), F.col("odd").alias("o")).agg(rows_())
    return o.join(n, F.col("subject").eqNullSafe(F.col("s")) & (F.col("odd") == F.col("o"))).select("row_id", "odd", "n")


ODD_FORMS = {"攺": "改", "攄": "據", "堍": "境", "碓": "確", "宄": "先"}


@query
def drv11_sibling_control(t):
    """Odd characters of a stem with their true form's occurrences in the stem itself and in the other questions of the paper."""
    forms = F.array(*[F.struct(F.lit(a).alias("odd"), F.lit(b).alias("true_form")) for a, b in ODD_FORMS.items()])
    times = lambda text, ch: (F.length(text) - F.length(F.replace(text, ch, F.lit("")))).cast("bigint")
    paper = F.nullif(gates.paper_of(F.col("qid")), F.lit(""))
    each = lambda df: df.where("stem is not null").select("*", F.explode(forms).alias("f")).select("*", "f.odd", "f.true_form").drop("f")
    s = each(t.bank.select("row_id", "qid", paper.alias("paper"), "stem")).where("contains(stem, odd)").select("row_id", "qid", "paper", "odd", "true_form", times(F.col("stem"), F.col("odd")).alias("times"), times(F.col("stem"), F.col("true_form")).alias("own"))
    q = each(t.q("stem").select("qid", paper.alias("paper"), "stem")).where("contains(stem, true_form)").select("qid", "paper", "odd", times(F.col("stem"), F.col("true_form")).alias("n"))
    by_paper = q.where("paper is not null").groupBy("paper", "odd").agg(F.sum("n").alias("in_paper"))
    of_qid = q.where("qid is not null and paper is not null").select("qid", "odd", F.col("n").alias("in_own"))
    j = s.join(by_paper, ["paper", "odd"], "left").join(of_qid, ["qid", "odd"], "left")
    n = (F.col("own") + F.coalesce("in_paper", F.lit(0)) - F.coalesce("in_own", F.lit(0))).cast("bigint")
    return j.select("row_id", "paper", "odd", "true_form", "times", n.alias("siblings"), (n > 0).alias("accepted"))


# --- parsing


@query
def par09_question_types(t):
    return t.q("subject", "answer", "options").groupBy("subject", tx.question_type(F.col("answer"), F.col("options")).alias("kind")).agg(rows_())


@query
def par10_domain_words(t):
    words = {"law": ["契約", "時效", "抗告", "損害賠償"], "history": ["王朝", "條約", "編年史", "族譜"], "geography": ["流域", "季風", "盆地", "海岸線"]}
    return t.documents.where("text is not null").select("doc_id", tx.domain_by_words(F.col("text"), words).alias("domain"))


@query
def par03_group_spans(t):
    """Groups that span more numbers than the limit, or have more or fewer members than their span."""
    g = t.q("group_id", "no", "passage").where("group_id is not null").groupBy("group_id").agg((F.max("no") - F.min("no") + 1).cast("bigint").alias("span"), rows_("members"), F.countDistinct("passage").alias("passages"))
    return g.withColumn("sane", F.coalesce((F.col("span") <= gates.GROUP_SPAN) & (F.col("members") == F.col("span")), F.lit(False)))


# --- joins


@query
def join01_semi_filter(t):
    """Questions of which the key knows the number of the paper; other numbers are spurious."""
    keys = t.bank.where("answer_src = 'key_pdf'").select(gates.paper_of(F.col("qid")).alias("paper"), "no").distinct()
    return t.q("no").select("row_id", "qid", gates.paper_of(F.col("qid")).alias("paper"), "no").join(keys, ["paper", "no"], "left_semi").select("row_id", "qid")


@query
def join02_group_passages(t):
    q = t.q("group_id", "no")
    g = q.where("group_id is not null").groupBy("group_id").agg(rows_("members"), F.min("no").alias("first_no"))
    return q.join(g, "group_id", "left").select("row_id", "members", "first_no")


@query
def join04_number_gaps(t):
    q = t.q("no").select("qid", "no", gates.paper_of(F.col("qid")).alias("paper"))
    w = Window.partitionBy("paper").orderBy("no", "qid")  # a paper's questions
    return q.withColumn("nxt", F.lead("no").over(w)).where("nxt > no + 1").select("qid", "no", "nxt")


@query
def join08_parity_grid(t):
    subjects = t.bank.where("subject is not null").select("subject").distinct()
    grid = subjects.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("arm"), "subject")
    e = t.answer_events.join(t.q("subject").select("qid", "subject"), "qid").groupBy((F.col("user_id") % 2).cast("int").alias("arm"), "subject").agg(rows_(), n_if(F.col("correct"), "hits"))
    return grid.join(e, ["arm", "subject"], "left").select("arm", "subject", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("hits", F.lit(0)).alias("hits"), F.when(F.col("n").isNull(), "missing").otherwise("present").alias("state"))


@query
def join09_figure_both_ways(t):
    """Files without a row, rows without a file, and contents that several names share; names by key."""
    from stemforge.operators.orphans import reference_key

    files = t.figure_files.select(reference_key(F.col("filename")).alias("name"), "sha1").where("name is not null")
    named = t.bank.select(reference_key(F.col("figure")).alias("name")).where("name is not null").distinct()
    side = lambda df, s: df.agg(F.lit(s).alias("side"), rows_())
    a = side(files.select("name").distinct().join(named, "name", "left_anti"), "file_without_row")
    b = side(named.join(files, "name", "left_anti"), "row_without_file")
    shared = files.groupBy("sha1").agg(F.countDistinct("name").alias("names")).where("names > 1")
    return a.unionByName(b).unionByName(side(shared, "shared_content"))


@query
def join12_stale_stamps(t):
    j = t.explanations.select("qid", "src_fp").join(t.q("stem").select("qid", "stem", F.lit(1).alias("found")), "qid", "left")
    now = F.substring(F.sha2(F.coalesce("stem", F.lit("")), 256), 1, 12)
    state = F.when(F.col("src_fp").isNull(), "unstamped").when(F.col("found").isNull(), "no_source").when(F.col("src_fp") == now, "current").otherwise("stale")
    return j.groupBy(state.alias("state")).agg(rows_())


@query
def join13_manifest_parity(t):
    """Fields of each question's first and last delivery compared by hash."""
    fields = ["stem", "answer", "passage", "figure"]
    hashed = lambda df, name: df.select("qid", F.col("row_id").alias(f"{name}_row"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.sha2(F.col(f), 256).alias("h")) for f in fields])).alias("e")).select("qid", f"{name}_row", F.col("e.field").alias("field"), F.col("e.h").alias(name))
    j = hashed(t.first(*fields), "old").join(hashed(t.q(*fields), "new"), ["qid", "field"]).where("old_row <> new_row")
    state = F.when(F.col("old").isNull() & F.col("new").isNull(), "both_null").when(F.col("old").isNull() | F.col("new").isNull(), "missing_field").when(F.col("old") == F.col("new"), "same").otherwise("hash_differs")
    return j.groupBy("field", state.alias("state")).agg(rows_())


@query
def join15_subject_overlap(t):
    """Questions by subject and exam, for all exams, and in how many exams the subject appears."""
    n = t.q("subject", "exam").groupBy("subject", "exam").agg(rows_())
    exams = n.where("exam is not null").groupBy("subject").agg(F.count("*").alias("exams"))
    return n.join(exams.withColumnRenamed("subject", "s"), F.col("subject").eqNullSafe(F.col("s")), "left").select("subject", "exam", "n", F.coalesce("exams", F.lit(0)).alias("exams"))


@query
def join20_name_suffixes(t):
    """Names that end with another name, by equality on exploded suffixes."""
    laws = t.anchor_packs.where("law is not null").select("law").distinct()
    ends = laws.where(F.length("law") > 1).select(F.col("law").alias("longer"), F.explode(F.transform(F.sequence(F.lit(2), F.length("law")), lambda i: F.expr("law").substr(i, F.length("law")))).alias("law"))
    return ends.join(laws, "law").select("longer", F.col("law").alias("shorter"))


@query
def join21_top_relations(t):
    """The first four questions by answers of each user; the limit is applied before the shuffle."""
    n = t.answer_events.where("qid is not null").groupBy("user_id", "qid").agg(rows_())
    return n.withColumn("pos", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("n"), "qid"))).where("pos <= 4").select("user_id", "qid", F.col("pos").cast("bigint").alias("pos"), "n")


@query
def join22_shared_explanations(t):
    m = t.bank.where("stem is not null and group_id is null").select("row_id", tx.full_fingerprint(F.col("stem"), F.col("options"), F.col("answer"), F.col("passage")).alias("fp"))
    f = m.groupBy("fp").agg(F.min("row_id").alias("lead_row"), rows_("members")).where("members > 1")
    return m.join(f, "fp").select("row_id", "lead_row", "members")


# --- aggregations


@query
def agg01_year_profile(t):
    q = t.q("year", "type", "answer", "needs_figure", "group_id")
    return q.groupBy("year").agg(rows_(), n_if(F.col("type") == "單選", "single"), n_if(F.col("answer") != "", "answered"), n_if(F.col("needs_figure"), "figures"), F.countDistinct("group_id").alias("groups_"))


@query
def agg06_status_rollup(t):
    """The best status of each question, and the row that keeps it: a measurement is never demoted."""
    rank = F.when(F.col("parse") == "ok", 0).when(F.col("parse") == "review", 1).otherwise(2)
    best = t.bank.groupBy("qid").agg(F.min_by(F.struct(F.col("parse").alias("status"), F.col("row_id").alias("kept_by")), F.struct(rank, "parse", "row_id")).alias("r"))
    return best.select("qid", "r.status", "r.kept_by")


@query
def agg09_finding_routes(t):
    c = F.col("c")
    route = F.when(F.col("t").isNull(), "input_gap").when(c.isin("high", "med", "low"), "publish").when(c.isNull(), "review").otherwise("remap")
    n = t.explanations.groupBy(route.alias("route")).agg(rows_())
    total = n.agg(F.sum("n").alias("total"))
    return n.crossJoin(F.broadcast(total)).select("route", "n", (F.col("n") / F.col("total")).alias("share"))  # four rows and one


@query
def agg10_failures_by_chunk(t):
    """Failures by chunk, and the share of the chunk with the most in all of them."""
    n = t.explanations.groupBy(F.floor(F.col("expl_id") / 30).cast("bigint").alias("chunk")).agg(rows_(), n_if(F.col("c") == "low", "low"))
    top = n.agg(F.max("low").alias("most"), F.sum("low").alias("all_low"))
    return n.crossJoin(F.broadcast(top)).select("chunk", "n", "low", F.round(F.col("most") / F.nullif("all_low", F.lit(0)), 6).alias("top_share"))  # one row


@query
def agg11_two_arm_union(t):
    wrong = t.answer_events.where("qid is not null and not correct")
    arm = lambda k: F.max(F.when(F.col("user_id") % 2 == k, 1).otherwise(0))
    return wrong.groupBy("qid").agg(arm(0).alias("a"), arm(1).alias("b")).agg(rows_("either"), F.sum(F.col("a") * F.col("b")).alias("both_"), F.sum("a").alias("arm_a"), F.sum("b").alias("arm_b"))


@query
def agg12_arm_overlap(t):
    e = t.answer_events.where("correct is not null").join(t.q("subject").select("qid", "subject"), "qid")
    arm = lambda k: F.max(F.when((F.col("user_id") % 2 == k) & ~F.col("correct"), 1).otherwise(0))
    per = e.groupBy("subject", "qid").agg(arm(0).alias("a"), arm(1).alias("b"))
    miss = (1 - F.col("b")).cast("double")
    return per.groupBy("subject").agg(F.round(F.avg(F.when(F.col("a") == 0, miss)), 6).alias("b_misses_given_a"), F.round(F.avg(miss), 6).alias("b_misses"))


@query
def agg13_wilson(t):
    g = t.q("subject", "parse").groupBy("subject").agg(n_if(F.col("parse") == "review", "k"), rows_())
    low, high = st.wilson(F.col("k"), F.col("n"))
    return g.select("subject", "k", "n", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"), st.escalate(F.col("k"), F.col("n")).alias("escalate"))


@query
def agg17_medians(t):
    return t.q("subject", "stem").where("stem is not null").groupBy("subject").agg(rows_(), F.median(F.length("stem").cast("double")).alias("mid")).where("n >= 12")


@query
def agg18_kappa(t):
    arm = lambda k: F.max(F.when((F.col("user_id") % 2 == k) & F.col("correct"), 1.0).otherwise(0.0))
    per = t.answer_events.where("qid is not null").groupBy("qid").agg(arm(0).alias("a"), arm(1).alias("b"))
    s = per.agg(F.avg(F.when(F.col("a") == F.col("b"), 1.0).otherwise(0.0)).alias("po"), F.avg("a").alias("pa"), F.avg("b").alias("pb"))
    pe = F.col("pa") * F.col("pb") + (1 - F.col("pa")) * (1 - F.col("pb"))
    return s.select(F.round(F.when(pe != 1, (F.col("po") - pe) / (1 - pe)), 6).alias("kappa"), F.round("po", 6).alias("agreement"))


@query
def agg20_batch_sizes(t):
    """Four times the items over the years, and one where a mismatch couldn't be detected, as no question has a key."""
    g = t.q("subject", "year", "answer_src").groupBy("subject").agg(rows_(), F.countDistinct("year").alias("years"), n_if(F.col("answer_src") == "key_pdf", "keys"))
    return g.select("subject", F.when(F.col("keys") > 0, F.ceil(4 * F.col("n") / F.greatest("years", F.lit(1)))).otherwise(1).cast("bigint").alias("batch"))


@query
def agg25_artifact_sizes(t):
    f = t.figure_files.where("deleted_at is null").groupBy("filename").agg(F.max("n_bytes").alias("n"))
    return f.agg(rows_("files"), F.sum("n").alias("bytes"), F.round(F.avg("n"), 4).alias("mean"))


@query
def agg26_reasons(t):
    r = t.bank.select("parse", F.explode("review_reasons").alias("reason")).where("parse is not null and reason is not null")
    return r.rollup("parse", "reason").agg(rows_()).select(F.coalesce("parse", F.lit("(all)")).alias("parse"), F.coalesce("reason", F.lit("(all)")).alias("reason"), "n")


@query
def agg27_sensitivity(t):
    n = F.length("stem")
    return t.bank.where("stem is not null").agg(rows_("rows"), n_if(n < 13, "strict"), n_if(n < 14, "looser"))


# --- windows


@query
def win01_anchor_fill(t):
    """The number of the last question of the paper that isn't a follow-up."""
    q = t.q("stem", "no").where("stem is not null and no is not null").select("qid", "no", gates.paper_of(F.col("qid")).alias("paper"), F.when(~F.col("stem").rlike(tx.FOLLOW_UP_WORDS), F.col("no")).alias("own"))
    w = Window.partitionBy("paper").orderBy("no", "qid").rowsBetween(Window.unboundedPreceding, 0)
    return q.select("qid", F.last("own", True).over(w).alias("anchor"))


@query
def win03_cooldown(t):
    """The questions of a user's pool whose fingerprint isn't among the last 30 answered; all of them where none is left."""
    fp = t.q("stem").where("stem is not null").select("qid", tx.stem_fingerprint(F.col("stem")).alias("fp"))
    seen = t.answer_events.where("qid is not null").groupBy("user_id", "qid").agg(F.max("ts").alias("last_ts")).join(fp, "qid")
    recent = seen.withColumn("k", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("last_ts"), "qid"))).where("k <= 30").select("user_id", "fp").distinct()
    pool = seen.join(recent.withColumn("hot", F.lit(True)), ["user_id", "fp"], "left")
    left = pool.groupBy("user_id").agg(n_if(F.col("hot").isNull(), "open"))
    return pool.join(left, "user_id").where("hot is null or open = 0").select("user_id", "qid", (F.col("open") == 0).alias("fallback"))


@query
def win05_chunks(t):
    """Chunks of 20 questions of a subject, of 12 among those with figures."""
    q = t.q("subject", "year", "no", "needs_figure").select("qid", "subject", "year", "no", F.coalesce("needs_figure", F.lit(False)).alias("figure"))
    k = rank_within(q, ["subject", "figure"], F.col("year"), [F.asc_nulls_last("no"), "qid"], "k")
    return k.select("qid", F.floor((F.col("k") - 1) / F.when(F.col("figure"), 12).otherwise(20)).cast("bigint").alias("chunk"))


@query
def win06_last_ten_years(t):
    n = t.q("subject", "year").where("year is not null").groupBy("subject", "year").agg(rows_())
    return n.withColumn("k", F.dense_rank().over(Window.partitionBy("subject").orderBy(F.desc("year")))).where("k <= 10").select("subject", "year", "n")  # one row per year


@query
def win07_interleave(t):
    q = t.q("subject", "year", "no").where("no is not null").select((F.col("no") % 2).cast("int").alias("arm"), "qid", "subject", "year", "no")
    k = rank_within(q, ["subject", "arm"], F.col("year"), ["no", "qid"], "k")
    return k.select("arm", "qid", (2 * (F.col("k") - 1) + F.col("arm")).cast("bigint").alias("slot"))


@query
def win08_next_item(t):
    q = t.q("no").select("qid", "no", gates.paper_of(F.col("qid")).alias("paper"))
    return q.select("qid", F.lead("no").over(Window.partitionBy("paper").orderBy("no", "qid")).alias("next_no"))


@query
def win10_freshness(t):
    """Levels older than 180 days at the time of the newest are unknown."""
    newest = t.explanations.agg(F.max("merged_at").alias("newest"))
    e = t.explanations.crossJoin(F.broadcast(newest))  # one row
    return e.select("expl_id", F.when(F.col("merged_at") < F.col("newest") - F.expr("interval 180 days"), "unknown").otherwise(F.col("c")).alias("c"))


# --- sorts, samples


@query
def srt02_sorted_sets(t):
    return t.bank.groupBy("subject").agg(F.array_join(F.array_sort(F.collect_set("year")).cast("array<string>"), ",").alias("years"))


@query
def srt04_listing_with_rest(t):
    """The first ten of each subject and how many are hidden; the limit is applied before the shuffle."""
    q = t.q("subject", "parse").where("parse <> 'ok'").select("subject", "qid")
    n = q.groupBy(F.col("subject").alias("s")).agg(F.greatest(F.count("*") - 10, F.lit(0)).alias("hidden"))
    top = q.withColumn("k", F.row_number().over(Window.partitionBy("subject").orderBy("qid"))).where("k <= 10")
    return top.join(n, F.col("subject").eqNullSafe(F.col("s"))).select("subject", "qid", F.col("k").cast("bigint").alias("k"), "hidden")


@query
def smp02_laplace_weights(t):
    e = t.answer_events.where("correct is not null").join(t.q("subject").select("qid", "subject"), "qid").groupBy("user_id", "subject").agg(rows_(), n_if(F.col("correct"), "ok"))
    return e.select("user_id", "subject", F.round(1 - (F.col("ok") + 1) / (F.col("n") + 2) + 0.15, 6).alias("weight"))


@query
def smp03_quota(t):
    """As many clean explanations of each level as there are dirty ones, in the order of a hash."""
    dirty = F.coalesce(F.col("t").rlike(r"\r"), F.lit(False))
    e = t.explanations.where("t is not null and c is not null").select("c", "expl_id", dirty.alias("dirty"), F.sha2(F.col("expl_id").cast("string"), 256).alias("h"))
    quota = e.where("dirty").groupBy("c").agg(rows_("quota"))
    k = rank_within(e.where("not dirty").select("c", "expl_id", "h"), ["c"], F.substring("h", 1, 3), ["h", "expl_id"], "k")
    return k.join(quota, "c").where("k <= quota").select("c", "expl_id")


@query
def smp05_least_mastered(t):
    e = t.answer_events.where("correct is not null").join(t.q("subject").where("subject is not null").select("qid", "subject"), "qid")
    per = e.groupBy("user_id", "subject").agg(F.round(F.avg(F.col("correct").cast("double")), 6).alias("ok"))
    return per.groupBy("user_id").agg(F.min(F.struct("ok", "subject")).alias("m")).select("user_id", "m.subject", "m.ok")


# --- sets, duplicates, derived checks


@query
def set03_validated(t):
    state = F.when(F.trim(F.coalesce("t", F.lit(""))) == "", "no_text").when(F.col("c").isNull() | ~F.col("c").isin("high", "med", "low"), "bad_level").otherwise("ok")
    return t.explanations.groupBy(state.alias("state")).agg(rows_())


@query
def set04_untouched(t):
    """Keys that an upsert of the later deliveries leaves alone have the same text as before; those that differ are counted."""
    bank = t.bank.select("qid", "stem", "loaded_at", "row_id")
    old = latest_rows(bank.where("loaded_at < timestamp_ntz '2024-07-01'"), ["qid"], ["loaded_at", "row_id"])
    new = bank.where("loaded_at >= timestamp_ntz '2024-07-01'")
    merged = maintain.upsert(old, new, "qid", ["loaded_at", "row_id"])
    j = merged.select("qid", "state", F.sha2("stem", 256).alias("now")).join(old.select("qid", F.sha2("stem", 256).alias("was")), "qid")
    return j.groupBy("state").agg(rows_("keys"), n_if(~F.col("now").eqNullSafe(F.col("was")), "touched"))


@query
def set11_real_proposals(t):
    j = t.proof_stems.select("row_id", F.col("stem").alias("proof")).join(t.bank.select("row_id", "stem"), "row_id")
    return j.where(~F.col("proof").eqNullSafe(F.col("stem"))).select("row_id")


@query
def set12_work_list(t):
    done = t.explanations.where("t is not null").select("qid")
    return t.q("parse").where("parse = 'ok'").join(done, "qid", "left_anti").select("qid")


@query
def dup01_fingerprints(t):
    """The newest row of each content is kept; short stems are never dropped."""
    f = t.bank.where("stem is not null").select("row_id", "year", tx.content_fingerprint(F.col("stem"), F.col("options")).alias("fp"), (F.length(tx.squeeze(F.col("stem"))) < 8).alias("short"))
    best = f.groupBy("fp").agg(F.max_by("row_id", F.struct(F.col("year"), -F.col("row_id"))).alias("keeper"))
    return f.join(best, "fp").select("row_id", (F.col("short") | (F.col("row_id") == F.col("keeper"))).alias("keep"))


@query
def dup02_session_exclusion(t):
    q = t.q("stem").select("qid", "stem").where(F.length(tx.squeeze(F.col("stem"))) >= 13).select("qid", tx.stem_fingerprint(F.col("stem")).alias("fp"))
    e = t.answer_events.where("qid is not null").select("user_id", "qid").distinct().join(q, "qid")
    first = e.groupBy("user_id", "fp").agg(F.min("qid").alias("first"))
    return e.join(first, ["user_id", "fp"]).select("user_id", "qid", (F.col("qid") == F.col("first")).alias("shown"))


@query
def dup03_extended_fingerprints(t):
    fp = tx.full_fingerprint(F.col("stem"), F.col("options"), F.col("answer"), F.col("passage"))
    f = t.bank.where("stem is not null").select("row_id", "qid", fp.alias("fp"))
    return f.groupBy("fp").agg(F.min("row_id").alias("lead_row"), rows_("rows"), F.countDistinct("qid").alias("qids")).where("rows > 1").select("lead_row", "rows", "qids")


@query
def dup05_shared_files(t):
    return t.figure_files.groupBy("sha1").agg(F.countDistinct("filename").alias("names")).where("names > 1")


@query
def dup06_first_by_number(t):
    return t.bank.where("no is not null").groupBy(gates.paper_of(F.col("qid")).alias("paper"), "no").agg(F.min("row_id").alias("first_row"))


@query
def dup03_document_copies(t):
    d = t.documents.where("text is not null").groupBy(F.sha2("text", 256).alias("h")).agg(F.min("doc_id").alias("lead_doc"), rows_("copies"), F.countDistinct("source").alias("sources"))
    return d.where("copies > 1").drop("h")


@query
def drv03_grading(t):
    """Answers graded where the question's status allows it; of the letters, accept counts besides the answer."""
    q = t.q("subject", "answer_status", "answer", "accept").select("qid", "subject", "answer_status", F.size(F.array_distinct(F.concat(tx.answer_letters(F.col("answer")), F.coalesce("accept", F.array().cast("array<string>"))))).alias("letters"))
    e = t.answer_events.where("correct is not null").select("qid", "correct").join(q.where(F.col("answer_status").isin(*gates.ANSWERABLE)), "qid")
    return e.groupBy("subject").agg(rows_("scored"), n_if(F.col("correct"), "right_"), n_if(F.col("letters") > 1, "several_letters"))


@query
def drv06_true_holes(t):
    e = t.explanations.select("qid")
    return t.q("parse", "answer_status").where("parse = 'ok' and answer_status <> 'free'").join(e, "qid", "left_anti").select("qid")


@query
def drv07_displayed_count(t):
    e = t.explanations.where("t is not null").select("qid")
    return t.q("subject", "answer_status").where(F.col("answer_status").isin(*gates.ANSWERABLE)).join(e, "qid", "left_semi").groupBy("subject").agg(rows_("shown"))


@query
def drv08_release_diff(t):
    o = t.first("stem").select("qid", F.col("stem").alias("was"))
    j = t.q("stem").select("qid", "stem").join(o, "qid")
    s = F.col("stem")
    return j.agg(rows_("keys"), n_if(~s.eqNullSafe(F.col("was")), "changed"), n_if(F.length("stem") < F.length("was"), "shorter"), n_if(s.rlike("^[，。、；]"), "leading_marks"), n_if(s.isNull(), "empty"))


@query
def drv13_error_tally(t):
    return t.answer_events.where("not correct and qid is not null").groupBy("user_id", "qid").agg(rows_("mistakes")).where("mistakes > 1")


@query
def drv17_sentinel(t):
    """A batch (subject and year) is reopened whole if one of its questions needs review."""
    q = t.q("subject", "year", "parse")
    bad = q.where("parse = 'review'").select(F.col("subject").alias("s"), F.col("year").alias("y")).distinct()
    return q.join(bad, F.col("subject").eqNullSafe(F.col("s")) & F.col("year").eqNullSafe(F.col("y")), "left_semi").select("qid")


@query
def drv20_judged_by(t):
    n = t.answer_events.where("qid is not null").groupBy("qid").agg(F.count_if(F.col("user_id") % 2 == 0).alias("a"), F.count_if(F.col("user_id") % 2 == 1).alias("b"))
    side = F.when((F.col("a") > 0) & (F.col("b") > 0), "both").when(F.col("a") > 0, "a_only").otherwise("b_only")
    return n.groupBy(side.alias("side")).agg(rows_())


@query
def drv28_started_prefixes(t):
    """Papers without any explanation."""
    started = t.explanations.where("qid is not null").select(gates.paper_of(F.col("qid")).alias("paper")).distinct()
    return t.bank.select(gates.paper_of(F.col("qid")).alias("paper")).where("paper <> ''").distinct().join(started, "paper", "left_anti")


@query
def geo10_band_outliers(t):
    """Figures shorter than 70 or taller than 730, by the prefix of their name."""
    prefix = F.regexp_extract("filename", r"^([^_]*)", 1)
    return t.figure_files.groupBy(prefix.alias("prefix")).agg(n_if(F.col("height") < 70, "short_"), n_if(F.col("height") > 730, "tall"), rows_("files"))


# --- sinks as data products


@query
def snk05_safe_json(t):
    return t.documents.where("text is not null").select("doc_id", tx.html_safe_json(F.to_json(F.struct("doc_id", F.concat("text", F.lit("</script>")).alias("text")))).alias("safe"))


@query
def snk07_bundle(t):
    """Each exam's questions, and how many explanations and figures go with them; an exam without questions isn't there."""
    q = t.q("exam", "figure").where("exam is not null").select("qid", "exam", "figure")
    e = t.explanations.where("t is not null and qid is not null").groupBy("qid").agg(rows_("texts"))
    return q.join(e, "qid", "left").groupBy("exam").agg(rows_("questions"), F.sum(F.coalesce("texts", F.lit(0))).alias("explanations"), F.countDistinct(F.nullif(F.trim("figure"), F.lit(""))).alias("figures"))


@query
def snk09_figure_collector(t):
    """Figure names of all shapes: the field, and images named in passages and tables."""
    marks = F.regexp_extract_all(F.concat_ws(" ", "passage", "table_md"), F.lit(r"\{img:([^}]*)\}|!\[[^\]]*\]\(([^)]*)\)"), 1)
    names = F.concat(F.array("figure"), marks)
    return t.bank.select(F.explode(names).alias("figure")).where("figure is not null and trim(figure) <> ''").distinct()


@query
def src12_newest_hit(t):
    e = t.explanations.where("t is not null and qid is not null")
    return e.groupBy("qid").agg(F.max_by("expl_id", F.struct("merged_at", "expl_id")).alias("expl_id"))
