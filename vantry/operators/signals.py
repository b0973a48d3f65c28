"""Transcripts, pose and pitch as time series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantry.functions import scalars as S
from vantry.operators.ranges import overlap_join, point_join


def assign_speakers(words: DataFrame, turns: DataFrame, width: float = 60.0) -> DataFrame:
    """case_id, turn, pos, speaker of every word: the speaker that overlaps it the longest (ties: the first by name); null without overlap."""
    spans = turns.select("case_id", F.col("start_s").alias("r_start"), F.col("end_s").alias("r_end"), F.col("speaker").alias("who"))
    rows = overlap_join(words.select("case_id", "turn", "pos", "start_s", "end_s"), spans, ["case_id"], width)
    overlap = F.least("end_s", "r_end") - F.greatest("start_s", "r_start")
    total = rows.groupBy("case_id", "turn", "pos", "who").agg(F.round(F.sum(overlap), 6).alias("s"))
    best = total.groupBy("case_id", "turn", "pos").agg(F.min(F.struct((-F.col("s")).alias("s"), "who")).alias("b"))
    named = best.select("case_id", "turn", "pos", F.col("b.who").alias("speaker"))
    return words.select("case_id", "turn", "pos").join(named, ["case_id", "turn", "pos"], "left")


def speaker_turns(words: DataFrame) -> DataFrame:
    """case_id, island, speaker, start_s, line: runs of words of one speaker, as lines of a plain transcript."""
    order = Window.partitionBy("case_id").orderBy("turn", "pos")
    named = words.withColumn("who", F.coalesce("speaker", F.lit("UNKNOWN")))
    marked = named.withColumn("new", (F.lag("who").over(order).isNull() | (F.lag("who").over(order) != F.col("who"))).cast("int"))
    numbered = marked.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    grouped = numbered.groupBy("case_id", "island", "who").agg(F.min_by("start_s", F.struct("turn", "pos")).alias("start_s"), F.array_sort(F.collect_list(F.struct("turn", "pos", F.trim("word").alias("w")))).alias("ws"))
    text = F.array_join(F.transform(F.filter("ws", lambda x: x.w != ""), lambda x: x.w), " ")
    return grouped.select("case_id", "island", F.col("who").alias("speaker"), "start_s", F.concat(F.lit("["), S.clock(F.col("start_s")), F.lit("] "), "who", F.lit(": "), text).alias("line"))


# Tiers that every annotation file starts with.
DEFAULT_TIERS = ("LEARNER", "PATIENT", "PRECEPTOR", "ANNOUNCEMENT", "OUTSIDE_ROOM")


def _spoken(words: DataFrame) -> DataFrame:
    """Words on speaker tiers, trimmed, without lone punctuation."""
    value = F.regexp_replace("word", r"^\s+|\s+$", "")
    tier = S.speaker_label(F.coalesce("speaker", F.lit("Unknown_Speaker"))).alias("tier")
    rows = words.select("case_id", tier, S.annotation_ms(F.col("start_s")).alias("start_ms"), S.annotation_ms(F.col("end_s")).alias("end_ms"), value.alias("value"))
    return rows.where(~F.col("value").isin("", ".", ",", "?", "!"))


def annotations(words: DataFrame) -> DataFrame:
    """case_id, tier, start_ms, end_ms, value: trimmed words on speaker tiers, without lone punctuation and empty spans."""
    return _spoken(words).where("end_ms > start_ms")


def tiers(words: DataFrame, default: tuple[str, ...] = DEFAULT_TIERS) -> DataFrame:
    """case_id, tier: the default tiers, and those of all spoken words, also of words whose span is empty."""
    given = words.select("case_id").distinct().withColumn("tier", F.explode(F.array(*map(F.lit, default))))
    return given.union(_spoken(words).select("case_id", "tier")).distinct()


def tier_counts(words: DataFrame, default: tuple[str, ...] = DEFAULT_TIERS) -> DataFrame:
    """case_id, tier, n annotations of every tier, 0 for empty ones."""
    found = annotations(words).groupBy("case_id", "tier").agg(F.count("*").alias("n"))
    return tiers(words, default).join(found, ["case_id", "tier"], "left").select("case_id", "tier", F.coalesce("n", F.lit(0)).alias("n"))


def visibility(pose: DataFrame, least: float = 0.3) -> DataFrame:
    """video, frame, slot, visible, label, x, y: a slot is visible if a point scores over `least`; its label stands at the least
    coordinates of such points, cut to integers, y less 8. Points: arrays of x and y; scores beside them."""
    seen = pose.withColumn("seen", F.filter(F.arrays_zip("points", "scores"), lambda p: p["scores"] > least))
    low = lambda k: F.array_min(F.transform("seen", lambda p: F.get(p["points"], F.lit(k)))).cast("bigint")
    return seen.select("video", "frame", "slot", (F.size("seen") > 0).alias("visible"), F.concat(F.lit("P"), F.col("slot")).alias("label"), low(0).alias("x"), (low(1) - 8).alias("y"))


def boundary_error(words: DataFrame, gold: DataFrame, keys: list[str]) -> DataFrame:
    """case_id, n, mean_s, median_s: distances of word starts and ends from those of the same word in the gold standard.

    Distances are whole microseconds, so their sums are exact; mean and median are rounded to microseconds, halves up."""
    both = words.join(gold.select(*keys, F.col("start_s").alias("gs"), F.col("end_s").alias("ge")), keys)
    micro = lambda a, b: F.rint(F.abs(F.col(a) - F.col(b)) * 1e6).cast("bigint")
    each = both.select("case_id", F.explode(F.array(micro("start_s", "gs"), micro("end_s", "ge"))).alias("d")).where("d is not null")
    halves = (2 * F.median("d")).cast("bigint")  # a median is a whole or a half
    mean = F.expr("(2 * sum(d) + count(*)) div (2 * count(*))")
    return each.groupBy("case_id").agg(F.count("*").alias("n"), (mean / 1e6).alias("mean_s"), (F.floor((halves + 1) / 2) / 1e6).alias("median_s"))


def feed_lag(left: DataFrame, right: DataFrame, lags: int) -> DataFrame:
    """pair, lag, r: the shift (of -lags to lags steps) at which two envelopes (pair, i, x) correlate best; ties: the least shift."""
    shifted = right.select("pair", F.col("x").alias("y"), (F.col("i")).alias("j")).withColumn("lag", F.explode(F.sequence(F.lit(-lags), F.lit(lags))))
    both = left.join(shifted.withColumn("i", F.col("j") + F.col("lag")), ["pair", "i"])
    fit = both.groupBy("pair", "lag").agg(F.round(F.corr("x", "y"), 6).alias("r"))
    best = fit.groupBy("pair").agg(F.max(F.struct("r", (-F.col("lag")).alias("back"))).alias("b"))
    return best.select("pair", (-F.col("b.back")).alias("lag"), "b.r")


def torso(points: Column) -> tuple[Column, Column]:
    """Angle of the shoulders (5, 6) in degrees and lean of the nose (0)."""
    at = lambda p, c: F.get(F.get(points, F.lit(p)), F.lit(c))
    return F.degrees(F.atan2(at(6, 1) - at(5, 1), at(6, 0) - at(5, 0))), at(0, 1) - (at(5, 1) + at(6, 1)) / 2


def facing_series(pose: DataFrame, k: int = 5) -> DataFrame:
    """video, frame, angle: moving average over k frames from each frame on, full windows only.

    A video of fewer frames than k takes the window's part: its sum over k stands in k - frames + 1 rows, from frame 0."""
    ahead = Window.partitionBy("video").orderBy("frame").rowsBetween(0, k - 1)
    rows = pose.select("video", "frame", torso(F.col("points"))[0].alias("a"))
    full = rows.select("video", "frame", F.avg("a").over(ahead).alias("angle"), F.count("*").over(ahead).alias("n")).where(F.col("n") == k).drop("n")
    short = rows.groupBy("video").agg(F.count("*").alias("n"), (F.sum("a") / k).alias("angle")).where(F.col("n") < k)
    return full.unionByName(short.select("video", F.explode(F.sequence(F.lit(0).cast("bigint"), k - F.col("n"))).alias("frame"), "angle"))


def wrist_velocity(pose: DataFrame, fps: float = 30.0) -> DataFrame:
    """video, frame, velocity: of the faster wrist (9, 10) to the next frame, in pixels a second."""
    w = Window.partitionBy("video").orderBy("frame")
    rows = pose.select("video", "frame", F.get("points", F.lit(9)).alias("l"), F.get("points", F.lit(10)).alias("r"))
    rows = rows.withColumn("nl", F.lead("l").over(w)).withColumn("nr", F.lead("r").over(w)).where("nl is not null")
    far = lambda a, b: F.sqrt(F.pow(F.get(b, F.lit(0)) - F.get(a, F.lit(0)), 2) + F.pow(F.get(b, F.lit(1)) - F.get(a, F.lit(1)), 2))
    return rows.select("video", "frame", (F.greatest(far(F.col("l"), F.col("nl")), far(F.col("r"), F.col("nr"))) * fps).alias("velocity"))


def pack_slots(detections: DataFrame, frames: DataFrame, slots: int = 4) -> DataFrame:
    """video, frame, slot, value: the first detections of each frame; every slot of every frame, 0 where empty."""
    spine = frames.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    kept = detections.where(F.col("det_idx") < slots).select("video", "frame", F.col("det_idx").alias("slot"), "value")
    return spine.join(kept, ["video", "frame", "slot"], "left").withColumn("value", F.coalesce("value", F.lit(0.0)))


def undetected(frames: DataFrame, detections: DataFrame) -> DataFrame:
    """video of videos that have frames, but no detection in any of them: nothing can be packed of them."""
    return frames.select("video").distinct().join(detections.select("video"), "video", "left_anti")


def held(frames: DataFrame, detections: DataFrame, every: int) -> DataFrame:
    """Detections of the last frame that was looked at, for every frame."""
    looked = detections.where(F.col("frame") % every == 0).withColumnRenamed("frame", "_looked")
    return frames.withColumn("_looked", F.col("frame") - F.col("frame") % every).join(looked, ["video", "_looked"]).drop("_looked")


def pitch_in_turns(pitch: DataFrame, turns: DataFrame, width: float = 86_400.0) -> DataFrame:
    return point_join(pitch.where("hz > 0"), turns, ["case_id"], "t", width)


def speaker_pitch(pitch: DataFrame, turns: DataFrame, least: int = 10) -> DataFrame:
    """case_id, speaker, median_hz, n_frames, bucket."""
    rows = pitch_in_turns(pitch, turns).groupBy("case_id", "speaker").agg(F.median("hz").alias("median_hz"), F.count("*").alias("n_frames"))
    return rows.where(F.col("n_frames") >= least).withColumn("bucket", S.pitch_bucket(F.col("median_hz")))


ACOUSTIC = ("pitch", "intensity", "harmonicity", "formant_1", "formant_2", "formant_3", "formant_4")


def acoustic_frames(tracks: DataFrame, duration: float, order: str = "t") -> DataFrame:
    """case_id, frame (from 1), start_s, end_s and ACOUSTIC, from tracks (case_id, t, ACOUSTIC): not-a-number becomes null in pitch and harmonicity
    and stays in intensity and formants; nulls stay null. `order` parts frames of one time."""
    n = F.row_number().over(Window.partitionBy("case_id").orderBy("t", order)).cast("bigint")
    value = {c: F.when(~F.isnan(c), F.col(c)) if c in ("pitch", "harmonicity") else F.col(c) for c in ACOUSTIC}
    return tracks.select("case_id", n.alias("frame"), F.greatest(F.lit(0.0), F.col("t") - duration / 2).alias("start_s"), (F.col("t") + duration / 2).alias("end_s"), *(v.cast("double").alias(c) for c, v in value.items()))


def turn_segments(turns: DataFrame) -> DataFrame:
    """case_id, idx, segment, label, speaker, start, end of turns by start, then end and speaker; labels A to Z, AA, AB and so on by place, segment as text of its bounds."""
    order = Window.partitionBy("case_id").orderBy("start_s", "end_s", "speaker")
    rows = turns.withColumn("idx", (F.row_number().over(order) - 1).cast("long"))
    segment = F.format_string("%.3f-%.3f", "start_s", "end_s")
    digits = [F.when(F.col("idx") >= low, F.chr(65 + F.pmod(F.floor((F.col("idx") - low) / 26**k), F.lit(26)))).otherwise("") for k, low in enumerate((0, 26, 26 + 26**2, 26 + 26**2 + 26**3))]
    return rows.select("case_id", "idx", segment.alias("segment"), F.concat(*reversed(digits)).alias("label"), "speaker", F.col("start_s").alias("start"), F.col("end_s").alias("end"))


def gold_turns(annotations: DataFrame, outside: str = "OUTSIDE_ROOM", label: str = "OTHER") -> DataFrame:
    """case_id, start_s, end_s, speaker of annotations (case_id, tier, start_ms, end_ms, value): all turns, those from outside the room under a general label."""
    who = F.when(F.col("tier") == outside, label).otherwise(F.col("tier"))
    return annotations.select("case_id", (F.col("start_ms") / 1000).alias("start_s"), (F.col("end_ms") / 1000).alias("end_s"), who.alias("speaker"))


def gold_lines(annotations: DataFrame, outside: str = "OUTSIDE_ROOM") -> DataFrame:
    """case_id, idx, line: trimmed annotations by start, end, tier and text, without blank ones and what is said outside the room."""
    value = F.trim("value")
    rows = annotations.where((F.col("tier") != outside) & (value != "")).select("case_id", "start_ms", "end_ms", "tier", value.alias("line"))
    order = Window.partitionBy("case_id").orderBy("start_ms", "end_ms", "tier", "line")
    return rows.select("case_id", (F.row_number().over(order) - 1).cast("long").alias("idx"), "line")
