"""State of the videos: work lists, canonical cameras, tallies."""

from __future__ import annotations

import traceback
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STATUSES = ("pending", "done", "failed", "skipped")


def pending(videos: DataFrame, cases: DataFrame, stage: str) -> DataFrame:
    return videos.where(F.col(f"{stage}_status") == "pending").join(cases, "case_id")


def elect_camera(videos: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """case_id, camera: a stored choice stays; else numeric ids by value, whatever their length, then others by string."""
    numeric = F.col("camera").rlike(r"^-?\d+$")
    digits = F.regexp_replace("camera", r"^-?0*", "")
    below = numeric & F.col("camera").startswith("-") & (digits != "")
    size = F.when(numeric, F.when(below, -F.length(digits)).otherwise(F.length(digits)))
    # of two negative numbers of one length that with the greater digits is the lesser: nines' complement turns their order
    value = F.when(below, F.translate(digits, "0123456789", "9876543210")).when(numeric, digits)
    order = F.struct((~numeric).alias("a"), size.alias("n"), value.alias("v"), F.col("camera").alias("c"))
    chosen = videos.groupBy("case_id").agg(F.min(order).alias("o")).select("case_id", F.col("o.c").alias("camera"))
    if stored is None:
        return chosen
    return chosen.join(stored.select("case_id", F.col("camera").alias("_kept")), "case_id", "left").select("case_id", F.coalesce("_kept", "camera").alias("camera"))


def without_camera(wanted: DataFrame, videos: DataFrame) -> DataFrame:
    """case_id of wanted cases that have no video, known or not: no camera can be elected for them."""
    return wanted.select("case_id").distinct().join(videos.select("case_id"), "case_id", "left_anti")


def skip_others(videos: DataFrame, elected: DataFrame, stage: str) -> DataFrame:
    """Pending rows of cameras that are not elected become skipped; nothing else changes."""
    column = f"{stage}_status"
    rows = videos.join(elected.withColumnRenamed("camera", "_chosen"), "case_id", "left")
    return rows.withColumn(column, F.when((F.col(column) == "pending") & (F.col("camera") != F.col("_chosen")), "skipped").otherwise(F.col(column))).drop("_chosen")


def stable_shard(rows: DataFrame, keys: list[str], index: int, of: int) -> DataFrame:
    """A share of the rows that does not change as others are finished."""
    if not 0 <= index < of:
        raise ValueError("0 <= index < of is needed")
    return rows.where(F.pmod(F.xxhash64(*keys), F.lit(of)) == index)


def shortest_first(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.coalesce("duration_s", F.lit(0.0)), "case_id", "camera")


def interleaved_rank(rows: DataFrame, of: int, range_rows: int = 250_000) -> DataFrame:
    """rank (0 is the shortest) and shard of each row, by duration (null is 0), case and camera.

    The whole key is cut into ranges of about `range_rows` rows, so equal durations spread over ranges by case and camera. A rank is the
    number of rows in the ranges before and the place in its own range; no task holds more than a range. Rows of one key share no order.
    """
    key = F.struct(F.coalesce("duration_s", F.lit(0.0)).cast("double").alias("d"), F.coalesce("case_id", F.lit("")).alias("c"), F.coalesce("camera", F.lit("")).alias("v"))
    keyed = rows.withColumn("_key", key)
    n = keyed.count()
    parts = max(8, -(-n // range_rows))
    # where ranges begin: any sample does, as rows are then counted against these keys
    begins = keyed.select("_key").repartitionByRange(parts, "_key").groupBy(F.spark_partition_id().alias("p")).agg(F.min("_key").alias("_begin")).select("_begin")
    edges = begins.agg(F.array_sort(F.collect_set("_begin")).alias("_edges"))  # one row of `parts` keys
    ranged = keyed.join(F.broadcast(edges)).withColumn("_range", F.size(F.filter("_edges", lambda e: e <= F.col("_key"))))
    ranged = ranged.drop("_edges")
    counts = ranged.groupBy("_range").count()
    starts = counts.select("_range", (F.sum("count").over(Window.orderBy("_range")) - F.col("count")).alias("_start"))  # one row a range
    place = F.row_number().over(Window.partitionBy("_range").orderBy("_key"))
    out = ranged.withColumn("_place", place).join(F.broadcast(starts), "_range").withColumn("rank", F.col("_start") + F.col("_place") - 1)
    return out.withColumn("shard", F.col("rank") % of).drop("_key", "_range", "_start", "_place")


def current_state(log: DataFrame) -> DataFrame:
    """case_id, camera, stage, status: the latest entry of an append-only log."""
    return log.groupBy("case_id", "camera", "stage").agg(F.max_by("status", F.struct("at", "attempt")).alias("status"))


def bad_updates(updates: DataFrame, videos: DataFrame) -> DataFrame:
    """case_id, camera, status, reason of rows with an illegal status (null is none) or without a video. Columns that are no state are refused."""
    if unknown := set(updates.columns) - {"case_id", "camera", "status"}:
        raise ValueError(f"unknown columns: {sorted(unknown)}")
    legal = F.coalesce(F.col("status").isin(*STATUSES), F.lit(False))
    illegal = updates.where(~legal).withColumn("reason", F.lit("status"))
    missing = updates.where(legal).join(videos.select("case_id", "camera"), ["case_id", "camera"], "left_anti").withColumn("reason", F.lit("key"))
    return illegal.unionByName(missing)


def only_case(rows: DataFrame, case_id: str | None) -> DataFrame:
    """The work list of one case; all of it for None."""
    return rows if case_id is None else rows.where(F.col("case_id") == case_id)


def reuse(todo: DataFrame, cache: DataFrame, keys: list[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows of the cache for the keys to do, and those that `work` makes of the keys it lacks; `cached` tells them apart."""
    known = cache.join(todo.select(*keys).distinct(), keys, "left_semi").withColumn("cached", F.lit(True))
    fresh = work(todo.join(cache.select(*keys).distinct(), keys, "left_anti"))
    return known.unionByName(fresh.withColumn("cached", F.lit(False)))


def run_stage(rows: DataFrame, work: Callable[[dict], dict | None], carried: tuple[str, ...] = ()) -> DataFrame:
    """case_id, camera, status, error_type, error_msg, extra and the carried columns: work(row) is called for each row in executor tasks;
    it may return column updates and its own status, and an exception fails its row alone."""
    columns = [c for c in rows.columns if c not in carried]
    names = ["case_id", "camera", "status", "error_type", "error_msg", "extra"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame[columns].to_dict("records"):
                try:
                    extra = dict(work(row) or {})
                    out.append((row["case_id"], row["camera"], extra.pop("status", "done"), None, None, {k: str(v) for k, v in extra.items()}))
                except Exception as error:  # noqa: BLE001  the batch goes on; the log has the error
                    out.append((row["case_id"], row["camera"], "failed", type(error).__name__, traceback.format_exception_only(error)[-1].strip(), {}))
            yield pd.DataFrame(out, columns=names).assign(**{c: frame[c].values for c in carried})

    kind = "case_id string, camera string, status string, error_type string, error_msg string, extra map<string,string>"
    return rows.mapInPandas(run, ", ".join([kind, *(f"{c} {rows.schema[c].dataType.simpleString()}" for c in carried)]))


def merge_forks(ours: DataFrame, theirs: DataFrame, column: str) -> DataFrame:
    """Both copies of a manifest by key: done before failed before skipped before pending; conflict marks differing rows."""
    rank = lambda c: F.array_position(F.array(*map(F.lit, ("done", "failed", "skipped", "pending"))), F.col(c))
    both = ours.select("case_id", "camera", F.col(column).alias("_a")).join(theirs.select("case_id", "camera", F.col(column).alias("_b")), ["case_id", "camera"], "full")
    status = F.when(F.col("_b").isNull() | (rank("_a") <= rank("_b")), F.col("_a")).otherwise(F.col("_b"))
    return both.select("case_id", "camera", status.alias(column), F.coalesce(F.col("_a") != F.col("_b"), F.lit(False)).alias("conflict"))
