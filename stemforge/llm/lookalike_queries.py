"""Problem 1 over explanations and law articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stemforge.llm.canonical import canonical_column, fit_scores
from stemforge.operators.blocks import expand_pairs, grouped_pairs
from stemforge.operators.snapshots import snapshot_numbers
from stemforge.plans.change_queries import ARTICLE_PARTS, ARTICLE_PLAIN, ARTICLE_SQL, fold_values, pack_articles
from stemforge.session import broadcast_below, cut, stored, table


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(text): all texts of both tables, with their repetitions."""
    articles = table(spark, sf_dir, "anchor_packs").select(F.explode(F.map_values("articles")).alias("text"))
    return table(spark, sf_dir, "explanations").select(F.col("t").alias("text")).unionByName(articles).where("text is not null")


def _digest(c: str) -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.md5(F.col(c)))


def _forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(stored, text, form): the distinct texts, each searched once."""
    texts = _texts(spark, sf_dir)
    once = stored(texts.distinct(), "texts")
    return once.select(_digest("text").alias("stored"), "text", canonical_column(fit_scores((texts, "text")), F.col("text")).alias("form"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with equal forms are paired as distinct stored texts, and the pairs expanded to the rows that have them; packs are compared with the row before in time."""
    keys = stored(_forms(spark, sf_dir).select("stored", _digest("form").alias("key")), "forms")
    expl = table(spark, sf_dir, "explanations").where("t is not null").select("expl_id", _digest("t").alias("stored"))
    classes = keys.join(expl.select("stored").distinct(), "stored", "left_semi")
    pairs = grouped_pairs(classes.select("key", F.struct("stored").alias("item")), "key", "item").select(F.col("a.stored").alias("a"), F.col("b.stored").alias("b"))
    a = expand_pairs(pairs, expl, "stored", "expl_id").select(F.lit("explanations").alias("src_table"), F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"), F.lit("").alias("art"))

    packs = table(spark, sf_dir, "anchor_packs")
    arts = pack_articles(packs).where("text is not null").select("pack_date", "pcode", "art", "pack_row", _digest("text").alias("stored"))
    arts = arts.join(broadcast_below(cut(snapshot_numbers(packs, "pack_date"))), "pack_date").join(keys, "stored")
    w = Window.partitionBy("pcode", "art").orderBy("seq")  # one row per snapshot
    old = F.lag(F.struct("seq", "pack_row", "stored", "key")).over(w).alias("old")
    both = arts.select("seq", "art", "pack_row", "stored", "key", old).where("old.seq = seq - 1 and old.key = key and old.stored <> stored")
    b = both.select(F.lit("anchor_packs").alias("src_table"), F.least("pack_row", "old.pack_row").alias("id_a"), F.greatest("pack_row", "old.pack_row").alias("id_b"), "art")
    return a.unionByName(b)


def p1_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src_table, id, art, form): every text of both tables in the consistent form."""
    scores = fit_scores((_texts(spark, sf_dir), "text"))
    expl = table(spark, sf_dir, "explanations").select(F.lit("explanations").alias("src_table"), F.col("expl_id").alias("id"), F.lit("").alias("art"), F.col("t").alias("text"))
    arts = table(spark, sf_dir, "anchor_packs").select(F.lit("anchor_packs").alias("src_table"), F.col("pack_row").alias("id"), F.explode_outer("articles").alias("art", "text"))
    return expl.unionByName(arts).select("src_table", "id", "art", canonical_column(scores, F.col("text")).alias("form"))


QUERIES = {"p1_found": p1_found, "p1_forms": p1_forms}

SQL = {
    "p1_found": f"""WITH fold(ch, folded) AS (VALUES {fold_values()}),
expl AS (SELECT expl_id, t AS text FROM explanations WHERE t IS NOT NULL),
valid AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pack_date, pcode ORDER BY loaded_at DESC, pack_row DESC) AS k FROM anchor_packs WHERE pcode IS NOT NULL AND pack_date IS NOT NULL) x WHERE k = 1),
dates AS (SELECT pack_date, lag(pack_date) OVER (ORDER BY pack_date) AS old_date FROM (SELECT DISTINCT pack_date FROM anchor_packs WHERE pack_date IS NOT NULL) x),
spelt AS (SELECT *, {ARTICLE_PLAIN} AS s FROM (SELECT pack_date, pcode, pack_row, e.key AS spelt, e.value AS text FROM (SELECT pack_date, pcode, pack_row, unnest(map_entries(articles)) AS e FROM valid) x) y),
arts AS (SELECT pack_date, pcode, pack_row, art, arg_min(coalesce(text, chr(1)), spelt) AS text FROM (SELECT *, {ARTICLE_SQL} AS art FROM (SELECT *, {ARTICLE_PARTS} FROM spelt) x) y GROUP BY ALL),
chars AS (SELECT text, unnest(string_split(text, '')) AS c, generate_subscripts(string_split(text, ''), 1) AS i FROM (SELECT text FROM expl UNION SELECT text FROM arts WHERE text <> chr(1)) x),
looks AS (SELECT text, nfc_normalize(string_agg(coalesce(folded, c), '' ORDER BY i)) AS look FROM chars LEFT JOIN fold ON ch = c GROUP BY text),
e AS (SELECT expl_id, text, look FROM expl JOIN looks USING (text)),
a AS (SELECT arts.*, look FROM arts JOIN looks USING (text))
SELECT 'explanations' AS src_table, x.expl_id AS id_a, y.expl_id AS id_b, '' AS art FROM e x JOIN e y ON x.look = y.look AND x.text <> y.text AND x.expl_id < y.expl_id
UNION ALL SELECT 'anchor_packs', least(n.pack_row, o.pack_row), greatest(n.pack_row, o.pack_row), n.art FROM a n JOIN dates d ON n.pack_date = d.pack_date JOIN a o ON o.pack_date = d.old_date AND o.pcode = n.pcode AND o.art = n.art AND o.look = n.look AND o.text <> n.text""",
}
