"""Filling containers of fixed capacity by vector best fit.

A container has three capacities: tokens, documents, and attention cost (the sum of its pieces' squared lengths, as
attention within documents costs). Items come in falling size; each goes to the open container, of those with room in
all three, whose weighted residual norm after the item is least, else to a new one. The search follows the token
residuals upwards and ends where they alone exceed the best norm, so no container is left out.

Items longer than the capacity are split into full pieces and a rest, and only those. Two of the capacities depend on
the token capacity T: ``attention_share`` * T * T, which binds where it is below 1, and ``documents_per_token`` * T. An
item whose own cost exceeds the attention capacity can't be split, so it gets a container in which the cost of that
item alone is allowed; none else joins it.

Items are spread by a hash of their ids over shards of about ``shard_items``, each packed by one task, so the work is
linear at any scale; a shard wastes less than one container at its end, of hundreds.

Items of size 0 or null take no room and are left out; equal ids are kept as they come, told apart by their order.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemforge.session import broadcast_below

WEIGHTS = (1.0, 0.02, 0.02)  # tokens, documents, attention cost
#: Attention capacity as a share of one full-length document's cost, and documents per token of capacity.
ATTENTION_SHARE, DOCUMENTS_PER_TOKEN = 0.9, 1 / 64


class BestFit:
    def __init__(self, tokens: int, documents: int, attention: float, weights: tuple[float, float, float] = WEIGHTS):
        self.cap = (tokens, documents, attention)
        self.weights = weights
        self.left: list[list[float]] = []
        self.by_tokens: dict[int, list[int]] = defaultdict(list)
        self.mask = 0

    def place(self, size: int) -> int:
        tokens, documents, attention = self.cap
        wt, wd, wa = self.weights
        cost = float(size) ** 2
        best, norm, at = -1, math.inf, size
        rest = self.mask >> size
        while rest:
            at += (rest & -rest).bit_length() - 1
            base = wt * ((at - size) / tokens) ** 2
            if base >= norm:
                break
            for k in self.by_tokens[at]:
                _, d, a = self.left[k]
                if d >= 1 and a >= cost:
                    n = base + wd * ((d - 1) / documents) ** 2 + wa * ((a - cost) / attention) ** 2
                    if n < norm:
                        best, norm = k, n
            rest = self.mask >> (at + 1)
            at += 1
        if best < 0:
            best = len(self.left)
            self.left.append([tokens, documents, max(attention, cost)])  # an item alone may cost more than the capacity
        else:
            old = int(self.left[best][0])
            self.by_tokens[old].remove(best)
            if not self.by_tokens[old]:
                self.mask &= ~(1 << old)
        own = self.left[best]
        own[0] -= size
        own[1] -= 1
        own[2] -= cost
        if own[0] > 0 and own[1] > 0:
            self.by_tokens[int(own[0])].append(best)
            self.mask |= 1 << int(own[0])
        return best

    def closed_by(self) -> list[str]:
        """For each container, which capacity is used up most."""
        names = ("tokens", "documents", "attention")
        return [names[min(range(3), key=lambda i: left[i] / self.cap[i])] for left in self.left]


def pack(
    items: DataFrame, specs: DataFrame, shard_items: int = 20_000, documents_per_token: float = DOCUMENTS_PER_TOKEN, attention_share: float = ATTENTION_SHARE, weights: tuple[float, float, float] = WEIGHTS
) -> DataFrame:
    """(spec, container, doc_id, piece, tokens, capacity_tokens, closed_by) for items (doc_id, tokens) and specs (spec, capacity_tokens).

    Containers are numbered from 0 within a spec's shard, shard * 2^32 on. closed_by is the capacity that is used up most
    in the container at the end: tokens, documents or attention. Specs without a name or a positive
    capacity pack nothing; of a spec given several times the greatest capacity counts.
    """
    items = items.where("tokens > 0").select("doc_id", F.col("tokens").cast("bigint").alias("size"))
    n = max(1, math.ceil(items.count() / shard_items))
    specs = specs.where("capacity_tokens > 0 and spec is not null").groupBy("spec").agg(F.max("capacity_tokens").cast("bigint").alias("capacity"))
    both = items.crossJoin(broadcast_below(specs, 10_000))  # each item is packed for each spec
    pieces = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("size") - 1) / F.col("capacity")).cast("bigint"))
    both = both.withColumn("piece", F.explode(pieces)).withColumn("tokens", F.least(F.col("capacity"), F.col("size") - F.col("piece") * F.col("capacity")).cast("bigint"))
    both = both.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(n)))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tokens", "doc_id", "piece"], ascending=[False, True, True])
        capacity = int(pdf["capacity"].iloc[0])
        bins = BestFit(capacity, max(1, int(capacity * documents_per_token)), attention_share * float(capacity) ** 2, weights)
        shard = int(pdf["shard"].iloc[0])
        places = np.fromiter((bins.place(int(t)) for t in pdf["tokens"]), np.int64, len(pdf))
        closed = np.array(bins.closed_by(), object)[places] if len(pdf) else []
        return pd.DataFrame({"spec": pdf["spec"], "container": places + (shard << 32), "doc_id": pdf["doc_id"], "piece": pdf["piece"].astype("int32"), "tokens": pdf["tokens"], "capacity_tokens": capacity, "closed_by": closed})

    return both.groupBy("spec", "shard").applyInPandas(fill, "spec string, container bigint, doc_id bigint, piece int, tokens bigint, capacity_tokens bigint, closed_by string")
