"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Rows are dealt into a fixed number of groups by a hash of their row number, so no key, source
or copy can crowd one of them. The driver draws how many rows of each group go to each shard:
row g of the matrix is a multivariate hypergeometric draw from the places still open, so that
all divisions of the rows are equally likely and every shard is filled exactly. Rows are
permuted within their group, cut by the matrix, exchanged, and permuted again within the shard.

Nulls, repeated rows and ties need no care: row numbers are unique. An empty table gives no
rows. Input columns of any name are kept, but for shard and slot, which the output replaces.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vantry.llm.scratch import written

GROUPS = 1024  # fixed: the matrix has GROUPS x shards counts, whatever the input


def hypergeometric(good: int, bad: int, drawn: int, rng: np.random.Generator) -> int:
    """Good ones among `drawn` from good + bad; by ratio of uniforms where the library's bound is passed."""
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, drawn)) if drawn else 0
    total = good + bad
    low, high = max(0, drawn - bad), min(drawn, good)
    mean = drawn * good / total
    width = math.sqrt(mean * (bad / total) * (total - drawn) / max(1, total - 1) + 0.5) * 1.7156 + 0.8989
    top = int((drawn + 1) * (good + 1) / (total + 2))
    log_p = lambda k: -(math.lgamma(k + 1) + math.lgamma(good - k + 1) + math.lgamma(drawn - k + 1) + math.lgamma(bad - drawn + k + 1))
    peak = log_p(top)
    while True:
        u = rng.random()
        k = math.floor(mean + 0.5 + width * (rng.random() - 0.5) / max(u, 1e-300))
        if low <= k <= high and 2 * math.log(max(u, 1e-300)) <= log_p(k) - peak:
            return k


def matrix(counts: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Rows of each group that go to each shard: row sums are counts, column sums are sizes."""
    rng, left, out = np.random.default_rng(seed), list(sizes), []
    for count in counts:
        row, need, pool = [], count, sum(left)
        for places in left:
            pool -= places
            row.append(hypergeometric(places, pool, need, rng) if pool else need)
            need -= row[-1]
        left = [a - b for a, b in zip(left, row, strict=True)]
        out.append(row)
    return out


def assign(rows: DataFrame, shards: int, seed: int = 20240229, groups: int = GROUPS) -> DataFrame:
    """rows with shard (0 to shards-1; counts at most one apart) and slot (gapless from 0 in each shard).

    Pass keys and what must travel with them; the rows are written once to the shared folder, so
    that row numbers stay the same if an executor is lost.
    """
    spark = rows.sparkSession
    rows = rows.drop("shard", "slot")
    named = written(rows.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("_row")), "shards")
    dealt = named.withColumn("_group", F.pmod(F.xxhash64("_row", F.lit(seed)), F.lit(groups)).cast("int"))

    counts = {r["_group"]: r["count"] for r in dealt.groupBy("_group").count().collect()}  # `groups` rows at most
    present = sorted(counts)
    total = sum(counts.values())
    sizes = [total // shards + (k < total % shards) for k in range(shards)]
    drawn = matrix([counts[g] for g in present], sizes, seed)
    cuts = [(g, np.cumsum(row).tolist()) for g, row in zip(present, drawn, strict=True)]
    cuts = spark.createDataFrame(cuts, "_group int, _cuts array<bigint>")

    local = Window.partitionBy("_group").orderBy(F.xxhash64("_row", F.lit(seed + 1)), "_row")
    sent = (
        dealt.withColumn("_place", F.row_number().over(local))
        .join(F.broadcast(cuts), "_group")
        .withColumn("shard", F.size(F.filter("_cuts", lambda cut: cut < F.col("_place"))))
        .drop("_cuts", "_place", "_group")
        .withColumn("_bin", F.pmod(F.xxhash64("_row", F.lit(seed + 2)), F.lit(groups)).cast("int"))
    )
    order = Window.partitionBy("shard").orderBy("_bin")
    bins = sent.groupBy("shard", "_bin").count()  # groups x shards rows at most
    starts = bins.select("shard", "_bin", (F.sum("count").over(order) - F.col("count")).alias("_start"))
    again = Window.partitionBy("shard", "_bin").orderBy(F.xxhash64("_row", F.lit(seed + 3)), "_row")
    return (
        sent.withColumn("_place", F.row_number().over(again))
        .join(F.broadcast(starts), ["shard", "_bin"])
        .select(*(F.col("row").getField(c).alias(c) for c in rows.columns), "shard", (F.col("_start") + F.col("_place") - 1).alias("slot"))
    )
