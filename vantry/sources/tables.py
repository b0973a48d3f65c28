"""The operators' input tables, derived from the warehouse tables by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def names(events: DataFrame) -> DataFrame:
    """File names of recordings; events may be a stream."""
    return events.select(F.concat(F.date_format("ts", "yyyyMMdd-HHmmss"), F.lit("-v"), "event_id", F.lit("-"), "user_id", F.lit(".mp4")).alias("filename"))


def recordings(spark, d):
    return names(table(spark, d, "events"))


def camera_rooms(spark, d):
    e = table(spark, d, "events").where("user_id % 11 <> 0")
    return e.select(F.col("user_id").cast("string").alias("camera_id"), F.lpad((F.col("user_id") % 30).cast("string"), 2, "0").alias("room_number")).distinct()


def cases(spark, d):
    e = table(spark, d, "events")
    both = e.where("event_id % 3 <> 0").withColumn("p", F.lit("C")).unionByName(e.where("event_id % 15 = 1").withColumn("p", F.lit("D")))
    return both.select(
        F.concat("p", "event_id").alias("case_id"), (F.col("user_id") % 30).cast("string").alias("room_number"), F.lower(F.date_format("ts", "MM/dd/yyyy hh:mm a")).alias("recording_start")
    )


def videos(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("case_id"),
        F.concat(F.when(F.col("o_orderkey") % 13 == 0, "x").otherwise(""), F.col("o_orderkey").cast("string")).alias("camera"),
        F.when(F.col("o_orderkey") % 17 == 0, None).otherwise(F.round(F.col("o_totalprice").cast("double") / 100, 4)).alias("duration_s"),
        F.when(F.col("o_orderstatus") == "P", "pending").when(F.col("o_orderstatus") == "F", "done").otherwise("failed").alias("pose_status"),
        F.when(F.col("o_orderkey") % 3 == 0, "pending").when(F.col("o_orderkey") % 3 == 1, "done").otherwise("failed").alias("asr_status"),
        *(F.element_at(F.array(*map(F.lit, ("pending", "done", "failed", "skipped"))), (F.col("o_orderkey") % n % 4 + 1).cast("int")).alias(f"{stage}_status") for stage, n in (("audio", 5), ("diarize", 7), ("elan", 11))),
    )


def words(spark, d, dealt: bool = False):
    """case_id, turn, pos, word, start_s, end_s, speaker. With dealt, turns go to the tasks of their case before they are split: what then groups
    by case moves no words, and a scan of few row groups does not hold all tasks up."""
    c = table(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("case_id"), "turn", F.col("role").alias("speaker"), "text")
    c = c.repartition("case_id") if dealt else c
    w = c.select("case_id", "turn", "speaker", F.posexplode(F.split(F.trim("text"), r"\s+")).alias("pos", "word"))
    start = F.col("turn") * 100 + F.col("pos") * 0.25
    return w.select("case_id", "turn", "pos", "word", start.cast("double").alias("start_s"), (start + F.col("pos") % 3 * 0.1).cast("double").alias("end_s"), "speaker")


def turns(spark, d):
    c = table(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("case_id"), "turn", "role")
    own = c.select("case_id", (F.col("turn") * 100 + 0.1).alias("start_s"), (F.col("turn") * 100 + 5 + F.col("turn") * 3).cast("double").alias("end_s"), F.col("role").alias("speaker"))
    other = c.where("turn % 2 = 0").select("case_id", (F.col("turn") * 100 + 4).cast("double").alias("start_s"), (F.col("turn") * 100 + 20).cast("double").alias("end_s"), F.lit("other").alias("speaker"))
    return own.unionByName(other)


def _t():
    """Seconds since the start of 2024."""
    return F.col("ts").cast("timestamp").cast("double") - F.lit("2024-01-01").cast("timestamp").cast("double")


def pitch(spark, d):
    return table(spark, d, "events").select(F.col("user_id").alias("case_id"), "event_id", _t().cast("double").alias("t"), F.when(F.col("event_type") == "error", 0.0).otherwise(110 + F.col("value")).cast("double").alias("hz"), F.col("value").cast("double").alias("intensity"))


def pitch_turns(spark, d):
    s = table(spark, d, "events").where("event_type = 'signup'")
    return s.select(F.col("user_id").alias("case_id"), F.concat(F.lit("S"), F.col("event_id") % 3).alias("speaker"), _t().cast("double").alias("start_s"), (_t() + 86400).cast("double").alias("end_s"))


def pose(spark, d):
    """video, frame, slot, points (32 of two coordinates), scores (one for each point)."""
    from pyspark.sql import Window

    e = table(spark, d, "embeddings")
    name = next(f.name for f in e.schema.fields if f.dataType.typeName() == "array")
    frame = (F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1).cast("bigint")
    points = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda j: F.array(12 * F.get(F.col(name), 2 * j).cast("double"), 12 * F.get(F.col(name), 2 * j + 1).cast("double")))
    scores = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda j: F.get(F.col(name), 2 * j).cast("double"))
    return e.select(F.col("label").alias("video"), frame.alias("frame"), F.lit(0).alias("slot"), points.alias("points"), scores.alias("scores"))


def detections(spark, d):
    from pyspark.sql import Window

    e = table(spark, d, "events").select((F.col("user_id") % 10).alias("video"), F.floor(_t() / 3600).alias("frame"), "event_id", "value")
    return e.withColumn("det_idx", F.row_number().over(Window.partitionBy("video", "frame").orderBy("event_id")) - 1)


def timing(spark, d):
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("run"), F.col("l_returnflag").alias("engine"), F.col("l_linestatus").alias("phase"), F.col("l_quantity").cast("double").alias("seconds"), F.col("l_extendedprice").cast("double").alias("audio_s")
    )


def whole_text_pairs(spark, d):
    """Whole texts of all languages, each with one of all benchmark items."""
    docs = table(spark, d, "documents")
    b = table(spark, d, "benchmark").select("item_id", F.col("text").alias("ref"))
    n = b.agg((F.max("item_id") + 1).alias("n"))  # one row
    return docs.join(F.broadcast(n)).join(b, F.col("item_id") == F.pmod("doc_id", "n")).select("doc_id", F.col("text").alias("hyp"), "ref")


def sheet_cells(spark, d):
    c = table(spark, d, "customer")
    rows = F.array(*(F.struct(F.lit(n).alias("row_no"), F.lit(label).alias("label"), v.cast("string").alias("value")) for n, label, v in ((2, "Event", F.col("c_mktsegment")), (5, "Room", F.col("c_nationkey")), (6, "Learners", F.col("c_name")), (10, "SPs", F.lit("ignored")))))
    return c.select(F.col("c_custkey").cast("string").alias("sheet"), F.explode(rows).alias("r")).select("sheet", "r.*")


def probe_json(spark, d):
    p = table(spark, d, "part")
    video = F.struct(F.lit("video").alias("codec_type"), F.concat("p_size", F.lit("/"), F.col("p_partkey") % 3).alias("avg_frame_rate"), (F.col("p_size") * 10).alias("width"), (F.col("p_size") * 5).alias("height"))
    audio = F.struct(F.lit("audio").alias("codec_type"), F.lit("0/0").alias("avg_frame_rate"), F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"))
    streams = F.when(F.col("p_partkey") % 2 == 0, F.array(video, audio)).otherwise(F.array(video))
    return p.select(F.col("p_partkey").alias("path"), F.to_json(F.struct(F.struct(F.col("p_retailprice").cast("string").alias("duration")).alias("format"), streams.alias("streams"))).alias("json"))
