"""Pose entries as tensors of person, frame and point, and as rows of slot and frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

POINTS = "array<array<float>>"  # points x coordinates
ENTRY = f"frame_dir string, total_frames long, img_shape array<int>, label int, keypoint array<array<{POINTS}>>, keypoint_score array<array<array<float>>>"
ROWS = f"video string, slot int, frame long, keypoint {POINTS}, score array<float>"


def rows_of(entries: DataFrame) -> DataFrame:
    """video, slot, frame, keypoint, score of entries (see ENTRY): a row for each person slot and frame, empty ones too. Nothing is shuffled.

    Scores stand beside the points of the same slot and frame; an entry without scores has null ones. Entries without points have no rows."""
    slots = entries.select(F.col("frame_dir").alias("video"), "keypoint_score", F.posexplode("keypoint").alias("slot", "_frames"))
    own = slots.select("video", "slot", F.get("keypoint_score", F.col("slot")).alias("_scores"), F.posexplode("_frames").alias("frame", "keypoint"))
    return own.select("video", "slot", F.col("frame").cast("long").alias("frame"), F.col("keypoint").cast(POINTS).alias("keypoint"), F.get("_scores", F.col("frame")).cast("array<float>").alias("score"))


def with_gaps_filled(rows: DataFrame, slots: int, points: int, coordinates: int) -> DataFrame:
    """Rows for every slot of every frame from 0 to a video's last, zeros where there is none; repeated rows of one place: the greatest stays."""
    whole = rows.groupBy("video").agg(F.max("frame").alias("_last"))
    frames = whole.select("video", F.explode(F.sequence(F.lit(0).cast("long"), "_last")).alias("frame"))
    spine = frames.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    zeros = lambda n: F.array_repeat(F.lit(0.0).cast("float"), n)
    own = rows.where(F.col("slot") < slots).groupBy("video", "slot", "frame").agg(F.max(F.struct("keypoint", "score")).alias("k"))
    both = spine.join(own, ["video", "slot", "frame"], "left")
    return both.select("video", "slot", "frame", F.coalesce("k.keypoint", F.array_repeat(zeros(coordinates), points)).cast(POINTS).alias("keypoint"), F.coalesce("k.score", zeros(points)).alias("score"))


def blocks_of(rows: DataFrame, frames: int = 256) -> DataFrame:
    """video, block, keypoint (slots x frames x points x coordinates), score (slots x frames x points): tensors of `frames` frames each.

    A whole video's tensor grows with its length; a block is bounded. Rows must hold every slot of every frame (see with_gaps_filled)."""
    place = F.struct("frame", "keypoint", "score").alias("p")
    slots = rows.groupBy("video", F.floor(F.col("frame") / frames).cast("long").alias("block"), "slot").agg(F.array_sort(F.collect_list(place), _by("frame")).alias("ps"))
    whole = slots.groupBy("video", "block").agg(F.array_sort(F.collect_list(F.struct("slot", "ps")), _by("slot")).alias("ss"))
    pick = lambda name: F.transform("ss", lambda s: F.transform(s["ps"], lambda p: p[name]))
    return whole.select("video", "block", pick("keypoint").alias("keypoint"), pick("score").alias("score"))


def _by(name: str):
    return lambda a, b: F.when(a[name] < b[name], -1).when(a[name] > b[name], 1).otherwise(0)


def rows_of_blocks(blocks: DataFrame, frames: int = 256) -> DataFrame:
    """The rows that blocks_of put together. Nothing is shuffled."""
    entries = blocks.select("video", "block", F.col("score").alias("keypoint_score"), "keypoint")
    slots = entries.select("video", "block", "keypoint_score", F.posexplode("keypoint").alias("slot", "_frames"))
    own = slots.select("video", "block", "slot", F.get("keypoint_score", F.col("slot")).alias("_scores"), F.posexplode("_frames").alias("_at", "keypoint"))
    return own.select("video", "slot", (F.col("block") * frames + F.col("_at")).alias("frame"), "keypoint", F.get("_scores", F.col("_at")).alias("score"))


def entries_of(rows: DataFrame, height: Column | None = None, width: Column | None = None) -> DataFrame:
    """Whole entries (see ENTRY), one a video, for videos short enough to be one row."""
    whole = blocks_of(rows, 1 << 40).drop("block")
    none = F.lit(None).cast("int")
    shape = F.array(none if height is None else height, none if width is None else width)
    return whole.select(F.col("video").alias("frame_dir"), F.size(F.get("keypoint", F.lit(0))).cast("long").alias("total_frames"), shape.alias("img_shape"), F.lit(0).alias("label"), "keypoint", F.col("score").alias("keypoint_score"))


def write_rows(rows: DataFrame, path: str) -> None:
    """Parquet in folders of video, each slot's frames in order."""
    rows.repartition("video", "slot").sortWithinPartitions("video", "slot", "frame").write.partitionBy("video").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROWS).parquet(path).select(*(c.split()[0] for c in ROWS.split(", ")))


def write_json(entries: DataFrame, path: str) -> None:
    """One JSON object a video."""
    entries.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """Entries from JSON, where points may be whole numbers."""
    return spark.read.schema(ENTRY).json(path)
