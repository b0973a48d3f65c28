"""Inventories, consent, samples and comparable runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vantry.functions import scalars as S


def registered_inventory(cases: DataFrame, matches: DataFrame, videos: DataFrame) -> DataFrame:
    """Matched cases with their videos and minutes."""
    found = cases.join(matches.select("case_id", "camera"), "case_id").join(videos.select("case_id", "camera", "duration_s"), ["case_id", "camera"])
    return found.withColumn("duration_min", F.col("duration_s") / 60).drop("duration_s")


def consent_gate(rows: DataFrame) -> DataFrame:
    """rows with accepted: false where consent_ref is null or blank."""
    return rows.withColumn("accepted", F.coalesce(F.trim("consent_ref") != "", F.lit(False)))


def stratified_sample(rows: DataFrame, stratum: str, key: str, size: int, seed: str = "") -> DataFrame:
    """`size` rows of each stratum, the least by a hash of seed and key: the same rows at each run, whatever the order."""
    rank = F.row_number().over(Window.partitionBy(stratum).orderBy(F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), key))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= size).drop("_rank")


def one_axis_sweep(runs: DataFrame, fields: list[str], measure: str) -> DataFrame:
    """Groups of runs that differ in one field alone: axis, the other fields (axis itself null), n_values, n_runs, least, most."""
    other = F.explode(F.array(*map(F.lit, fields))).alias("axis")
    spread = runs.groupBy(*fields).agg(F.count("*").alias("n"), F.min(measure).alias("lo"), F.max(measure).alias("hi")).select("*", other)
    value = F.coalesce(*(F.when(F.col("axis") == f, F.col(f).cast("string")) for f in fields)).alias("value")
    fixed = [F.when(F.col("axis") != f, F.col(f)).alias(f) for f in fields]
    groups = spread.select("axis", *fixed, value, "n", "lo", "hi").groupBy("axis", *fields)
    return groups.agg(F.countDistinct("value").alias("n_values"), F.sum("n").alias("n_runs"), F.min("lo").alias("least"), F.max("hi").alias("most")).where("n_values > 1")


def by_duration(inventory: DataFrame) -> DataFrame:
    """An inventory from the shortest to the longest; those without a length first."""
    return inventory.orderBy("duration_min", "case_id", "camera")


#: Columns of a benchmark's log, in their order.
RUN_COLUMNS = ("timestamp", "case_id", "engine", "model", "audio_sha256", "wer", "cer", "wall_s", "git_commit", "machine", "notes")


def benchmark_runs(refs: DataFrame, hyps: DataFrame, runs: DataFrame) -> DataFrame:
    """RUN_COLUMNS of each run: refs (case_id, text), hyps (case_id, engine, model, text), runs with what else they know of
    themselves (case_id, engine, model, timestamp, audio_sha256, wall_s, git_commit, machine, notes). Error rates are of normalised texts."""
    both = hyps.withColumnRenamed("text", "hyp").join(refs.withColumnRenamed("text", "ref"), "case_id").join(runs, ["case_id", "engine", "model"])
    ref, hyp = S.normalized_text(F.col("ref")), S.normalized_text(F.col("hyp"))
    scored = both.withColumn("wer", S.word_error_rate(ref, hyp)).withColumn("cer", S.char_error_rate(ref, hyp)).withColumn("wall_s", F.round("wall_s", 1))
    return scored.select(*RUN_COLUMNS)
