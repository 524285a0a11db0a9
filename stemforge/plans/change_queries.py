"""Queries of the snapshot and orphan operators over the question-bank tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemforge.functions.lookalike import fold_table, look_key_col
from stemforge.functions.numerals import article_number
from stemforge.operators.orphans import Ledger, existence_deltas, orphan_keys, orphan_references, reference_deltas, reference_key
from stemforge.operators.snapshots import SnapshotStore, snapshot_numbers, valid_packs
from stemforge.session import broadcast_below, cut, fresh_dir, stored, table

SEP = "\u001f"


def pack_articles(packs: DataFrame) -> DataFrame:
    """(pack_date, pcode, pack_row, art, text) of the valid packs; of two spellings of one number the lesser counts. Done row by row, without a shuffle of the texts."""
    entry = lambda e: F.struct(article_number(e["key"]).alias("art"), e["key"].alias("spelt"), e["value"].alias("text"))
    rows = valid_packs(packs).select("pack_date", "pcode", "pack_row", F.array_sort(F.transform(F.map_entries("articles"), entry)).alias("own"))
    before = F.concat(F.array(F.lit(None).cast("string")), F.slice(F.col("own.art"), 1, F.greatest(F.size("own") - 1, F.lit(0))))
    rows = rows.where(F.size("own") > 0).select("pack_date", "pcode", "pack_row", F.explode(F.arrays_zip(F.col("own").alias("own"), before.alias("before"))).alias("e"))
    return rows.where("not (e.own.art <=> e.before)").select("pack_date", "pcode", "pack_row", "e.own.art", "e.own.text")


def pack_digests(packs: DataFrame) -> DataFrame:
    """(pack_date, key, digest): what is compared of each pack; art '' carries the amend_date. A null text equals only a null text."""
    digest = lambda c: F.unhex(F.md5(F.coalesce(F.concat(F.lit("t"), c), F.lit("n")).cast("binary")))
    texts = pack_articles(packs).select("pack_date", F.concat_ws(SEP, "pcode", "art").alias("key"), digest(look_key_col(F.col("text"))).alias("digest"))
    dates = valid_packs(packs).select("pack_date", F.concat(F.col("pcode"), F.lit(SEP)).alias("key"), digest(F.col("amend_date").cast("string")).alias("digest"))
    return texts.unionByName(dates)


def pack_changes(packs: DataFrame, store: SnapshotStore | None = None) -> DataFrame:
    """(pack_date, pcode, art, change) between consecutive packs, by the ordinals and containers of the store; without one, of a new store in the shared folder."""
    spark = packs.sparkSession
    numbers = broadcast_below(cut(snapshot_numbers(packs, "pack_date")))  # one row per snapshot
    rows = pack_digests(packs).join(numbers, "pack_date").select("seq", "key", "digest")
    found = (store or SnapshotStore(spark, fresh_dir(spark, "packs"))).advance(rows).join(numbers, "seq")
    return found.select("pack_date", F.split("key", SEP)[0].alias("pcode"), F.split("key", SEP)[1].alias("art"), "change")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pack_changes(table(spark, sf_dir, "anchor_packs"))
    kind = F.when(F.col("art") == "", F.when(F.col("change") == "changed", "amend_date")).otherwise(F.when(F.col("change") == "changed", "amended").otherwise(F.col("change")))
    return found.select(F.date_format("pack_date", "yyyy-MM-dd").alias("pack_date"), "pcode", "art", kind.alias("change_type")).where("change_type is not null")


def p3_change_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_found(spark, sf_dir).groupBy("pack_date", "change_type").agg(F.count("*").alias("n"), F.countDistinct("pcode").alias("laws"))


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src_table, src_id, target, key, at) of all tables that refer to others; an event delivered twice counts once, as received first."""
    bank = table(spark, sf_dir, "bank").select(F.lit("bank").alias("src_table"), F.col("row_id").alias("src_id"), F.lit("figure_files").alias("target"), reference_key(F.col("figure")).alias("key"), F.col("loaded_at").alias("at"))
    expl = table(spark, sf_dir, "explanations").select(F.lit("explanations").alias("src_table"), F.col("expl_id").alias("src_id"), F.lit("bank").alias("target"), reference_key(F.col("qid")).alias("key"), F.col("merged_at").alias("at"))
    once = table(spark, sf_dir, "answer_events").where("event_id is not null").groupBy("event_id").agg(F.min_by(F.struct("qid", "ts"), F.struct("received_at", "ts", "qid")).alias("e"))
    events = once.select(F.lit("answer_events").alias("src_table"), F.col("event_id").alias("src_id"), F.lit("bank").alias("target"), reference_key(F.col("e.qid")).alias("key"), F.col("e.ts").alias("at"))
    return bank.unionByName(expl).unionByName(events)


def reference_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(target, key, born, gone) of all tables that are referred to."""
    bank = table(spark, sf_dir, "bank").select(F.lit("bank").alias("target"), reference_key(F.col("qid")).alias("key"), F.col("loaded_at").alias("born"), F.col("removed_at").alias("gone"))
    files = table(spark, sf_dir, "figure_files").select(F.lit("figure_files").alias("target"), reference_key(F.col("filename")).alias("key"), F.col("rendered_at").alias("born"), F.col("deleted_at").alias("gone"))
    return bank.unionByName(files)


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = stored(references(spark, sf_dir).where("key is not null"), "references")  # read for the counts and for the rows
    deltas = reference_deltas(refs).unionByName(existence_deltas(reference_targets(spark, sf_dir)))
    return orphan_references(refs, Ledger(spark, fresh_dir(spark, "ledger")).advance(deltas))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orphans(spark, sf_dir).select("src_table", "src_id", "reason")


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans per table, month and reason."""
    return _orphans(spark, sf_dir).groupBy("src_table", F.date_format("at", "yyyy-MM").alias("month"), "reason").agg(F.count("*").alias("n"))


def p4_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(target, key, refs, alive): keys that at the end of all deltas are referred to and don't exist. Two deliveries: the references, then the records, which arrive later."""
    ledger = Ledger(spark, fresh_dir(spark, "ledger"))
    ledger.advance(reference_deltas(references(spark, sf_dir)))
    return orphan_keys(ledger.advance(existence_deltas(reference_targets(spark, sf_dir)))).select("target", "key", "refs", "alive")


_WIDE = "".join(chr(0xFF01 + i) for i in range(94)) + "　"
_NARROW = "".join(chr(0x21 + i) for i in range(94)).replace("'", "''") + " "
_KEY = f"nullif(lower(regexp_replace(translate(@@, '{_WIDE}', '{_NARROW}'), '^[\\s\\x{{a0}}]+|[\\s\\x{{a0}}]+$', '', 'g')), '')"
_P4 = f"""WITH refs AS (
  SELECT 'bank' AS src_table, row_id AS src_id, 'f' AS target, {_KEY.replace("@@", "figure")} AS k, loaded_at AS t_at FROM bank
  UNION ALL SELECT 'explanations', expl_id, 'b', {_KEY.replace("@@", "qid")}, merged_at FROM explanations
  UNION ALL SELECT DISTINCT 'answer_events', event_id, 'b', {_KEY.replace("@@", "qid")}, ts FROM answer_events),
targets AS (
  SELECT target, k, min(born) AS born, CASE WHEN count(*) = count(gone) THEN max(gone) END AS gone FROM (
    SELECT 'b' AS target, {_KEY.replace("@@", "qid")} AS k, loaded_at AS born, removed_at AS gone FROM bank
    UNION ALL SELECT 'f', {_KEY.replace("@@", "filename")}, rendered_at, deleted_at FROM figure_files) t GROUP BY target, k),
found AS (
  SELECT r.*, CASE WHEN t.k IS NULL THEN 'missing' WHEN r.t_at < t.born THEN 'late' WHEN t.gone <= r.t_at THEN 'deleted' END AS reason
  FROM refs r LEFT JOIN targets t ON r.target = t.target AND r.k = t.k WHERE r.k IS NOT NULL)
"""
_NUMERAL = "[零〇一二兩三四五六七八九十百千萬億]"
# Chinese numerals up to 9999 in SQL: digits before each unit.
NUMERAL_PART = "CASE WHEN {0} = '' THEN '' WHEN regexp_full_match({0}, '[0-9]+') THEN CAST(CAST({0} AS BIGINT) AS VARCHAR) WHEN regexp_full_match({0}, '[零〇一二兩三四五六七八九]+') THEN CAST(CAST(translate({0}, '零〇一二兩三四五六七八九', '001223456789') AS BIGINT) AS VARCHAR) ELSE CAST(" + " + ".join(
    f"{v} * CASE WHEN NOT contains({{0}}, '{u}') THEN 0 ELSE coalesce(TRY_CAST(translate(regexp_extract({{0}}, '([一二兩三四五六七八九])?{u}', 1), '一二兩三四五六七八九', '1223456789') AS BIGINT), 1) END" for u, v in (("千", 1000), ("百", 100), ("十", 10))
) + " + coalesce(TRY_CAST(translate(regexp_extract({0}, '([一二兩三四五六七八九])$', 1), '一二兩三四五六七八九', '1223456789') AS BIGINT), 0) AS VARCHAR) END"


def fold_values() -> str:
    """The fold of single characters as SQL rows: character and what it becomes."""
    quoted = lambda x: "'" + (x or "").replace("'", "''") + "'"
    rows = ((chr(cp), to if isinstance(to, str) else "" if to is None else chr(to)) for cp, to in sorted(fold_table().items()))
    return ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in rows if a != b and a != "\0" and not 0xD800 <= ord(a) < 0xE000)


_SHAPE = f"'^第?([0-9]+|{_NUMERAL}+)條?(?:[-之]([0-9]+|{_NUMERAL}+))?條?$'"
#: Article numbers in SQL: from ``spelt`` to s, from s to major and minor, and from those to the number.
ARTICLE_PLAIN = f"regexp_replace(regexp_replace(translate(spelt, '{_WIDE}', '{_NARROW}'), '[\\s\\p{{Z}}\\x{{200b}}-\\x{{200f}}\\x{{2060}}\\x{{feff}}\\x{{ad}}\\x{{fe0e}}]+', '', 'g'), '[\\x{{2010}}-\\x{{2015}}\\x{{2212}}]', '-', 'g')"
ARTICLE_PARTS = f"regexp_extract(s, {_SHAPE}, 1) AS major, regexp_extract(s, {_SHAPE}, 2) AS minor"
ARTICLE_SQL = f"CASE WHEN major = '' THEN s ELSE {NUMERAL_PART.format('major')} || CASE WHEN minor = '' THEN '' ELSE '-' || {NUMERAL_PART.format('minor')} END END"
_P3 = f"""WITH fold(ch, folded) AS (VALUES {fold_values()}),
valid AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pack_date, pcode ORDER BY loaded_at DESC, pack_row DESC) AS k FROM anchor_packs WHERE pcode IS NOT NULL AND pack_date IS NOT NULL) x WHERE k = 1),
dates AS (SELECT pack_date, lag(pack_date) OVER (ORDER BY pack_date) AS old_date FROM (SELECT DISTINCT pack_date FROM anchor_packs WHERE pack_date IS NOT NULL) x),
spelt AS (SELECT *, {ARTICLE_PLAIN} AS s FROM (SELECT pack_date, pcode, e.key AS spelt, e.value AS text FROM (SELECT pack_date, pcode, unnest(map_entries(articles)) AS e FROM valid) x) y),
arts AS (SELECT pack_date, pcode, {ARTICLE_SQL} AS art, spelt, text FROM (SELECT *, {ARTICLE_PARTS} FROM spelt) x),
one AS (SELECT pack_date, pcode, art, arg_min(coalesce(text, chr(1)), spelt) AS text FROM arts GROUP BY ALL),
chars AS (SELECT text, unnest(string_split(text, '')) AS c, generate_subscripts(string_split(text, ''), 1) AS i FROM (SELECT DISTINCT text FROM one) x),
looks AS (SELECT text, nfc_normalize(string_agg(coalesce(folded, c), '' ORDER BY i)) AS look FROM chars LEFT JOIN fold ON ch = c GROUP BY text),
rows_ AS (SELECT pack_date, pcode, art, coalesce(look, '') AS v FROM one LEFT JOIN looks USING (text) UNION ALL SELECT pack_date, pcode, '', coalesce(CAST(amend_date AS VARCHAR), '-') FROM valid),
new AS (SELECT r.*, d.pack_date AS at FROM rows_ r JOIN dates d ON r.pack_date = d.pack_date WHERE d.old_date IS NOT NULL),
old AS (SELECT r.*, d.pack_date AS at FROM rows_ r JOIN dates d ON r.pack_date = d.old_date),
found AS (SELECT strftime(coalesce(n.at, o.at), '%Y-%m-%d') AS pack_date, coalesce(n.pcode, o.pcode) AS pcode, coalesce(n.art, o.art) AS art,
  CASE WHEN coalesce(n.art, o.art) = '' THEN CASE WHEN n.v <> o.v THEN 'amend_date' END WHEN o.v IS NULL THEN 'added' WHEN n.v IS NULL THEN 'removed' WHEN n.v <> o.v THEN 'amended' END AS change_type
  FROM new n FULL OUTER JOIN old o ON n.at = o.at AND n.pcode = o.pcode AND n.art = o.art)
SELECT pack_date, pcode, art, change_type FROM found WHERE change_type IS NOT NULL"""
_LEDGER = """SELECT CASE target WHEN 'b' THEN 'bank' ELSE 'figure_files' END AS target, k AS key, CAST(sum(refs) AS BIGINT) AS refs, CAST(sum(alive) AS BIGINT) AS alive FROM (
  SELECT target, k, 1 AS refs, 0 AS alive FROM refs WHERE k IS NOT NULL
  UNION ALL SELECT 'b', {0}, 0, CASE WHEN removed_at IS NULL THEN 1 ELSE 0 END FROM bank
  UNION ALL SELECT 'f', {1}, 0, CASE WHEN deleted_at IS NULL THEN 1 ELSE 0 END FROM figure_files) d WHERE k IS NOT NULL GROUP BY target, k HAVING sum(refs) > 0 AND sum(alive) <= 0""".format(_KEY.replace("@@", "qid"), _KEY.replace("@@", "filename"))
SQL = {
    "p3_found": _P3,
    "p3_change_counts": f"SELECT pack_date, change_type, count(*) AS n, count(DISTINCT pcode) AS laws FROM ({_P3}) f GROUP BY ALL",
    "p4_ledger": _P4 + _LEDGER,
    "p4_found": _P4 + "SELECT src_table, src_id, reason FROM found WHERE reason IS NOT NULL",
    "p4_report": _P4 + "SELECT src_table, strftime(t_at, '%Y-%m') AS month, reason, count(*) AS n FROM found WHERE reason IS NOT NULL GROUP BY ALL",
}
QUERIES = {"p3_found": p3_found, "p3_change_counts": p3_change_counts, "p4_found": p4_found, "p4_report": p4_report, "p4_ledger": p4_ledger}
