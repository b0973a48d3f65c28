"""Tallies, timings and flags over stages, turns and poses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def status_tally(videos: DataFrame, stages: dict[str, str]) -> DataFrame:
    """stage, status, n videos; stages: name of each stage and its column. All stages are counted in one pass."""
    each = F.explode(F.array(*(F.struct(F.lit(name).alias("stage"), F.col(column).alias("status")) for name, column in stages.items()))).alias("x")
    return videos.select(each).groupBy("x.stage", "x.status").agg(F.count("*").alias("n"))


def outcome_tally(videos: DataFrame, stages: dict[str, str]) -> DataFrame:
    """stage, ok, n: videos of each stage that are done or skipped, and those that failed; pending ones and nulls are left out."""
    told = status_tally(videos, stages).where("status <> 'pending'")
    return told.groupBy("stage", F.col("status").isin("done", "skipped").alias("ok")).agg(F.sum("n").alias("n"))


def prerequisite(todo: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """todo with ready: whether `done` has their keys, any of case, camera, engine and model. Null keys are never ready."""
    mark = done.select(*keys).distinct().withColumn("ready", F.lit(True))
    return todo.join(mark, keys, "left").select(*todo.columns, F.coalesce("ready", F.lit(False)).alias("ready"))


def camera_spread(videos: DataFrame, most: float) -> DataFrame:
    """case_id, spread: cases whose longest and shortest video are more than `most` seconds apart."""
    return videos.groupBy("case_id").agg((F.max("duration_s") - F.min("duration_s")).alias("spread")).where(F.col("spread") > most)


def register_counts(speakers: DataFrame) -> DataFrame:
    """case_id, bucket, n speakers."""
    return speakers.groupBy("case_id", "bucket").agg(F.count("*").alias("n"))


def slot_presence(pose: DataFrame, *keys: str) -> DataFrame:
    """Share of a video's (or a slot's) frames that have any point: keys, presence."""
    return pose.groupBy(*keys).agg(F.avg(F.exists(F.flatten("points"), lambda x: x != 0).cast("double")).alias("presence"))


def looking_away(angle: Column, most: float = 20) -> Column:
    """Whether the head is turned by more than `most` degrees to either side."""
    return F.abs(angle) > most


def gesturing(velocity: Column, least: float = 150) -> Column:
    """Whether a wrist moves by more than `least` pixels a second."""
    return velocity > least


def stage_profile(timing: DataFrame) -> DataFrame:
    """engine, phase, seconds, share (percent of the engine's seconds)."""
    rows = timing.groupBy("engine", "phase").agg(F.sum("seconds").alias("seconds"))
    return rows.withColumn("share", 100 * F.col("seconds") / F.greatest(F.sum("seconds").over(Window.partitionBy("engine")), F.lit(1e-9)))


def realtime_factor(timing: DataFrame, *keys: str) -> DataFrame:
    """keys, factor: seconds of work for a second of sound; null without sound."""
    return timing.groupBy(*keys).agg(F.try_divide(F.sum("seconds"), F.sum("audio_s")).alias("factor"))


def realtime_rows(timing: DataFrame) -> DataFrame:
    """timing rows with realtime_factor (3 digits), seconds (2) and audio_s (1), as a timing log keeps them; no factor without sound."""
    factor = F.round(F.try_divide("seconds", "audio_s"), 3)
    return timing.withColumns({"realtime_factor": factor, "seconds": F.round("seconds", 2), "audio_s": F.round("audio_s", 1)})


def engine_savings(timing: DataFrame) -> DataFrame:
    """engine, other, saved: what part of the other engine's seconds each engine saves. Engines are few, so their pairs are few."""
    e = timing.groupBy("engine").agg(F.sum("seconds").alias("s"))
    o = e.select(F.col("engine").alias("other"), F.col("s").alias("os"))
    return e.join(o, e.engine < o.other).select("engine", "other", (1 - F.try_divide("s", "os")).alias("saved"))


def total_cost(timing: DataFrame, keys: list[str], within: list[str]) -> DataFrame:
    """keys, seconds, ratio: seconds of all phases, and what part they are of the slowest with the same `within` (some of the keys)."""
    sums = timing.groupBy(*keys).agg(F.sum("seconds").alias("seconds"))
    most = F.max("seconds").over(Window.partitionBy(*within))
    return sums.withColumn("ratio", F.try_divide("seconds", most))


def hypothesis_text(words: DataFrame) -> DataFrame:
    """case_id, hypothesis: a case's words in order, without blank ones."""
    rows = words.where(F.trim("word") != "").groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("turn", "pos", F.trim("word").alias("w")))).alias("ws"))
    return rows.select("case_id", F.array_join(F.transform("ws", lambda x: x.w), " ").alias("hypothesis"))


def transcript_text(transcripts: DataFrame) -> DataFrame:
    """transcripts with hypothesis: the trimmed texts of the segments where there are any and all have one; else the trimmed words, those
    of the root before those of the segments. Joined by blanks, as they come."""
    join = lambda parts: F.array_join(F.transform(parts, lambda x: F.trim(F.coalesce(x, F.lit("")))), " ")
    spoken = (F.size("segments") > 0) & F.forall("segments", lambda s: s["text"].isNotNull())
    inner = F.flatten(F.filter(F.transform("segments", lambda s: s["words"]), lambda w: w.isNotNull()))
    words = F.when(F.size("words") > 0, F.col("words")).otherwise(F.coalesce(inner, F.array().cast(transcripts.schema["words"].dataType)))
    text = F.when(F.coalesce(spoken, F.lit(False)), join(F.transform("segments", lambda s: s["text"]))).otherwise(join(F.transform(words, lambda w: w["word"])))
    return transcripts.withColumn("hypothesis", text)
