"""Interval joins as equi-joins on time buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], width: float) -> DataFrame:
    """Pairs of one key whose intervals (start_s, end_s; right: r_start, r_end) overlap; each pair comes once.

    Both sides go to the buckets they touch; a pair counts only in the first bucket that both touch.
    """
    buckets = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / width), F.floor(F.greatest(a, b) / width)))
    both = left.withColumn("_bucket", buckets("start_s", "end_s")).join(right.withColumn("_bucket", buckets("r_start", "r_end")), [*keys, "_bucket"])
    first = F.greatest(F.floor(F.col("start_s") / width), F.floor(F.col("r_start") / width))
    return both.where((F.col("start_s") < F.col("r_end")) & (F.col("r_start") < F.col("end_s")) & (F.col("_bucket") == first)).drop("_bucket")


def point_join(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, width: float) -> DataFrame:
    """Points (at) within intervals (start_s <= at < end_s) of one key; a point in several intervals comes several times."""
    spread = intervals.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("start_s") / width), F.floor(F.col("end_s") / width))))
    both = points.withColumn("_bucket", F.floor(F.col(at) / width)).join(spread, [*keys, "_bucket"])
    return both.where((F.col(at) >= F.col("start_s")) & (F.col(at) < F.col("end_s"))).drop("_bucket")
