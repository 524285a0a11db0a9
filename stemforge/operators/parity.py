"""Whether the arms of a comparison got the same task: a ledger of what was prompted and delivered, asserted block by block."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemforge.session import broadcast_below


def record(texts: DataFrame, text: Column, mask: str | None = None) -> DataFrame:
    """Ledger columns of a prompt: prompt_sha and chars, blanks at line ends and the masked path apart."""
    from stemforge.functions.textcols import prompt_digest

    return texts.withColumn("prompt_sha", prompt_digest(text, mask)).withColumn("chars", F.length(text))


def parity(ledger: DataFrame, arms: DataFrame, blocks: DataFrame) -> DataFrame:
    """(block, arm, state) for every arm (arm) and block (block, newer_than), from ledger rows (arm, block, prompt_sha, delivered_sha, channel, ts).

    The last row of an arm and block counts. state, in this order: ``missing`` no record; ``stale`` recorded before
    newer_than (a null newer_than asks for nothing); ``drift`` delivered otherwise than prompted; ``unequal`` the block's
    arms were prompted differently; ``unverified`` an agent's delivery that wasn't captured; else ``ok``.
    """
    last = ledger.groupBy("block", "arm").agg(F.max_by(F.struct("prompt_sha", "delivered_sha", "channel", "ts"), F.struct("ts", "prompt_sha")).alias("r"))
    grid = blocks.crossJoin(broadcast_below(arms, 1_000))  # what is expected: each arm of each block
    j = grid.join(last, ["block", "arm"], "left").select("block", "arm", "newer_than", "r.*", F.col("r").isNotNull().alias("there"))
    kinds = j.groupBy("block").agg(F.countDistinct("prompt_sha").alias("prompts"))
    state = (
        F.when(~F.col("there"), "missing")
        .when(F.coalesce(F.col("ts") < F.col("newer_than"), F.lit(False)), "stale")
        .when(F.col("delivered_sha") != F.col("prompt_sha"), "drift")
        .when(F.col("prompts") > 1, "unequal")
        .when((F.coalesce("channel", F.lit("agent")) == "agent") & F.col("delivered_sha").isNull(), "unverified")
        .otherwise("ok")
    )
    return j.join(kinds, "block").select("block", "arm", state.alias("state"))
