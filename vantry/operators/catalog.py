"""Recordings, rooms and encounters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantry.functions import scalars as S

NAME = r"^(\d{8})-(\d{6})-(v\d+)-(\d+)$"


def parse_names(files: DataFrame) -> DataFrame:
    """filename, ok, video_date, video_time, recording_id, camera. The time is sliced, not checked."""
    stem = F.regexp_replace("filename", r"\.[^.]*$", "")
    part = lambda k: F.regexp_extract(stem, NAME, k)
    date = F.date_format(F.expr("try_to_date(_d, 'yyyyMMdd')"), "yyyy-MM-dd")
    t = part(2)
    rows = files.withColumn("_d", F.when(stem.rlike(NAME), part(1)))
    return rows.select("filename", date.isNotNull().alias("ok"), date.alias("video_date"), F.concat_ws(":", F.substring(t, 1, 2), F.substring(t, 3, 2), F.substring(t, 5, 2)).alias("video_time"), part(3).alias("recording_id"), part(4).alias("camera"))


def room_map(rooms: DataFrame) -> DataFrame:
    """cam, room: normalised; of ids that are normalised alike the last in string order counts."""
    return rows_by(rooms).groupBy("cam").agg(F.max_by("room", "camera_id").alias("room"))


def rows_by(rooms: DataFrame) -> DataFrame:
    return rooms.select(S.normalize_identifier(F.col("camera_id")).alias("cam"), S.normalize_identifier(F.col("room_number")).alias("room"), "camera_id")


def case_minutes(cases: DataFrame) -> DataFrame:
    return cases.select("case_id", S.normalize_identifier(F.col("room_number")).alias("room"), S.minute_bucket(S.recording_start(F.col("recording_start"))).alias("minute")).where("minute is not null")


def match(parsed: DataFrame, rooms: DataFrame, cases: DataFrame) -> DataFrame:
    """filename, status (no_room, no_match, matched, ambiguous), case_id, room, candidates. Files of one room and minute share
    the candidates, which are listed once for each room and minute before they meet the files."""
    listed = case_minutes(cases).groupBy("room", "minute").agg(F.array_sort(F.collect_list("case_id")).alias("found"))
    rows = parsed.where("ok").select("filename", S.normalize_identifier(F.col("camera")).alias("cam"), S.minute_bucket(F.concat_ws("T", "video_date", "video_time")).alias("minute"))
    rows = rows.join(room_map(rooms), "cam", "left").join(listed, ["room", "minute"], "left")
    n = F.coalesce(F.size("found"), F.lit(0))
    status = F.when(F.col("room").isNull(), "no_room").when(F.col("minute").isNull(), "bad_time").when(F.col("found").isNull(), "no_match").when(n == 1, "matched").otherwise("ambiguous")
    rows = rows.withColumn("status", status)
    hit = F.col("status") == "matched"
    return rows.select("filename", "status", F.when(hit, F.get("found", F.lit(0))).alias("case_id"), F.when(hit, F.col("room")).otherwise("").alias("room"), F.when(F.col("status") == "ambiguous", F.array_join("found", ",")).otherwise("").alias("candidates"))


def media_facts(probes: DataFrame) -> DataFrame:
    """path, duration_s (0 where missing or no number), fps (null without one), width, height, has_audio (false without streams)."""
    kind = "struct<format:struct<duration:string>,streams:array<struct<codec_type:string,avg_frame_rate:string,width:int,height:int>>>"
    rows = probes.withColumn("j", F.from_json("json", kind))
    rows = rows.withColumn("v", F.get(F.filter("j.streams", lambda s: s.codec_type == "video"), F.lit(0)))
    rate = F.split("v.avg_frame_rate", "/")
    fps = F.try_divide(F.get(rate, F.lit(0)).try_cast("double"), F.get(rate, F.lit(1)).try_cast("double"))
    return rows.select("path", F.coalesce(F.col("j.format.duration").try_cast("double"), F.lit(0.0)).alias("duration_s"), fps.alias("fps"), F.col("v.width").alias("width"), F.col("v.height").alias("height"), F.coalesce(F.exists("j.streams", lambda s: s.codec_type == "audio"), F.lit(False)).alias("has_audio"))


def sheets_to_cases(cells: DataFrame) -> DataFrame:
    """One case for each sheet, by label; rows 2 to 9 only; the last row of a label counts; blanks are ''."""
    labels = ["Event", "Case", "Group", "Room", "Learners", "SPs", "Recording start"]
    names = ["event_name", "case_name", "group_name", "room_number", "learner_name", "sp_name", "recording_start_time"]
    wide = cells.where("row_no between 2 and 9").groupBy(F.col("sheet").alias("case_id")).pivot("label", labels).agg(F.max_by("value", "row_no"))
    return wide.select("case_id", *(F.coalesce(F.col(f"`{a}`"), F.lit("")).alias(b) for a, b in zip(labels, names, strict=True)))


def relative_path(path: Column, root: str) -> Column:
    """A path under root without it; any other path as it stands."""
    base = root.rstrip("/") + "/"
    return F.when(path.startswith(base), F.substr(path, F.lit(len(base) + 1))).otherwise(path)


def import_sheets(cells: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cases to add, ids added, ids skipped as they are known already: known cases stay as they are."""
    made = sheets_to_cases(cells)
    sheets = cells.select(F.col("sheet").alias("case_id")).distinct()
    blank = [f.name for f in made.schema.fields if f.name != "case_id"]
    whole = sheets.join(made, "case_id", "left").fillna("", blank)  # a sheet without any known row is a case too
    fresh = absent(whole, known, ["case_id"])
    return fresh, fresh.select("case_id"), sheets.join(known.select("case_id"), "case_id", "left_semi")


def latest(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The last row of each key: an upsert over an append-only table."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def absent(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not known yet: to insert, or foreign keys that are refused."""
    return rows.join(known.select(*keys), keys, "left_anti")


def repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def insert_if_absent(known: DataFrame, rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows to add and the rows refused: their key is known, or stands more than once among them."""
    twice = repeated(rows, keys).select(*keys)
    fresh = absent(absent(rows, known, keys), twice, keys)
    return fresh, absent(rows, fresh, keys)


def lookup(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Each wanted key with its row; nulls where there is none."""
    return wanted.select(*keys).distinct().join(rows, keys, "left")


def listing(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in the string order of their keys."""
    return rows.orderBy(*(F.col(k).cast("string") for k in keys))


def rematch(cached: DataFrame, recordings: DataFrame, rooms: DataFrame, cases: DataFrame) -> DataFrame:
    """Matches of all recordings: cached `matched` rows stay, every other file is matched again."""
    kept = cached.where("status = 'matched'").join(recordings.select("filename"), "filename", "left_semi")
    fresh = match(parse_names(absent(recordings.select("filename"), kept, ["filename"])), rooms, cases)
    return kept.unionByName(fresh)
