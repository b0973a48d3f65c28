"""Stages by name, run over their pending rows into a status log that only grows.

The log is a Parquet table in folders of stage and run. A row is one attempt: case_id, camera, status, attempt, place (its order within
the attempt: side effects come after the row that caused them), error_type, error_msg, extra (column updates as text). State is folded
from the log, never written: a run that stops half way leaves the shares it finished, and the next one does what is still pending.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vantry.operators import manifest

# The stages of a recording, in their order.
STAGES = ("audio", "asr", "diarize", "elan", "pose")
LOG = "case_id string, camera string, status string, attempt int, place int, error_type string, error_msg string, extra map<string,string>, stage string, run long"


@dataclass(frozen=True)
class Stage:
    """work: what is done for a row, see manifest.run_stage. One that is not per_camera does its work for a case's elected camera alone and skips the others.
    needs: the stage that has to be done before for the same case and camera, else the row fails. effects: statuses that a success gives to other stages."""

    name: str
    work: Callable[[dict], dict | None]
    per_camera: bool = False
    needs: str | None = None
    effects: tuple[tuple[str, str], ...] = ()


class Registry:
    def __init__(self, *stages: Stage):
        self.stages: dict[str, Stage] = {}
        for stage in stages:
            self.add(stage)

    def add(self, stage: Stage) -> None:
        if stage.name not in STAGES or stage.name in self.stages:
            raise ValueError(f"no such stage, or registered before: {stage.name}")
        if bad := [s for s, status in stage.effects if s not in STAGES or status not in manifest.STATUSES]:
            raise ValueError(f"unknown effects: {bad}")
        self.stages[stage.name] = stage

    def __getitem__(self, name: str) -> Stage:
        if name not in self.stages:
            raise KeyError(f"{name}: one of {sorted(self.stages)} is needed")
        return self.stages[name]


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log; empty where none was written yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], LOG)
    return spark.read.schema(LOG).parquet(path)


def folded(log: DataFrame) -> DataFrame:
    """case_id, camera, <stage>_status of every stage (null: never tried), attempts of all stages, and updates: the last text of each updated column."""
    last = F.struct("run", "attempt", "place")
    status = [F.max_by(F.when(F.col("stage") == s, F.col("status")), F.when(F.col("stage") == s, last)).alias(f"{s}_status") for s in STAGES]
    tries = [F.coalesce(F.max(F.when(F.col("stage") == s, F.col("attempt"))), F.lit(0)).alias(f"{s}_attempts") for s in STAGES]
    wide = log.groupBy("case_id", "camera").agg(*status, *tries)
    each = log.select("case_id", "camera", last.alias("last"), F.explode("extra").alias("name", "value"))
    newest = each.groupBy("case_id", "camera", "name").agg(F.max_by("value", "last").alias("value"))
    updates = newest.groupBy("case_id", "camera").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("updates"))  # one entry a column
    return wide.join(updates, ["case_id", "camera"], "left")


def state(videos: DataFrame, log: DataFrame) -> DataFrame:
    """videos with <stage>_status from the log; what the log has not tried keeps the status that videos have, or is pending."""
    now = folded(log).withColumnsRenamed({f"{s}_status": f"_{s}" for s in STAGES})
    first = lambda s: F.col(f"{s}_status") if f"{s}_status" in videos.columns else F.lit(None).cast("string")
    both = videos.join(now, ["case_id", "camera"], "left")
    done = {f"{s}_status": F.coalesce(F.col(f"_{s}"), first(s), F.lit("pending")) for s in STAGES}
    tries = {f"{s}_attempts": F.coalesce(F.col(f"{s}_attempts"), F.lit(0)) for s in STAGES}
    return both.withColumns({**done, **tries}).drop(*(f"_{s}" for s in STAGES))


def run(registry: Registry, name: str, videos: DataFrame, path: str, run_id: int, shares: int = 1, only: str | None = None) -> DataFrame:
    """Does what is pending of a stage, or of one case, and returns the state after it.

    The work is written share by share (by a hash of the key), each by one commit of Spark's writer, to the folder of run_id; run_ids must
    grow, and a run repeated under its own id goes on where it stopped. A row's error fails that row alone. An earlier failure is not tried again, as it is not pending;
    `retry` makes it pending."""
    spark = videos.sparkSession
    stage = registry[name]
    for share in range(shares):
        now = state(videos, read_log(spark, path))
        todo = manifest.only_case(now.where(F.col(f"{name}_status") == "pending"), only).where(F.pmod(F.xxhash64("case_id", "camera"), F.lit(shares)) == share)
        todo = todo.withColumn("_attempt", F.col(f"{name}_attempts") + 1)
        skipped = None
        if not stage.per_camera:
            elected = manifest.elect_camera(videos).withColumnRenamed("camera", "_chosen")
            todo = todo.join(elected, "case_id")
            skipped = _plain(todo.where("camera <> _chosen"), F.lit("skipped"), None)
            todo = todo.where("camera = _chosen").drop("_chosen")
        blocked = None
        if stage.needs:
            ready = F.col(f"{stage.needs}_status") == "done"
            blocked = _plain(todo.where(~ready), F.lit("failed"), f"run the {stage.needs} stage first")
            todo = todo.where(ready)
        done = manifest.run_stage(todo, stage.work, ("_attempt",)).withColumnRenamed("_attempt", "attempt")
        rows = done.select("case_id", "camera", "status", "attempt", F.lit(0).alias("place"), "error_type", "error_msg", "extra", F.lit(name).alias("stage"))
        if stage.effects:
            given = F.array(F.struct(F.lit(name).alias("stage"), F.col("status"), F.lit(0).alias("place")), *(F.struct(F.lit(s).alias("stage"), F.lit(v).alias("status"), F.lit(k + 1).alias("place")) for k, (s, v) in enumerate(stage.effects)))
            own = F.array(F.struct(F.lit(name).alias("stage"), F.col("status"), F.lit(0).alias("place")))
            spread = rows.withColumn("_e", F.explode(F.when(F.col("status") == "done", given).otherwise(own)))
            empty = F.lit(None).cast("map<string,string>")
            rows = spread.select("case_id", "camera", "_e.status", "attempt", "_e.place", "error_type", "error_msg", F.when(F.col("_e.place") == 0, F.col("extra")).otherwise(empty).alias("extra"), "_e.stage")
        for more in (skipped, blocked):
            if more is not None:
                rows = rows.unionByName(more.withColumn("stage", F.lit(name)))
        rows.withColumn("run", F.lit(run_id).cast("long")).write.mode("append").partitionBy("stage", "run").parquet(path)
    return state(videos, read_log(spark, path))


def _plain(rows: DataFrame, status: Column, error: str | None) -> DataFrame:
    kind, text = (F.lit("FileNotFoundError"), F.lit(error)) if error else (F.lit(None).cast("string"), F.lit(None).cast("string"))
    return rows.select("case_id", "camera", status.alias("status"), F.col("_attempt").alias("attempt"), F.lit(0).alias("place"), kind.alias("error_type"), text.alias("error_msg"), F.lit(None).cast("map<string,string>").alias("extra"))


def retry(videos: DataFrame, name: str, path: str, run_id: int) -> None:
    """Failed rows of a stage become pending again, as rows of the log."""
    failed = state(videos, read_log(videos.sparkSession, path)).where(F.col(f"{name}_status") == "failed").withColumn("_attempt", F.col(f"{name}_attempts"))
    rows = _plain(failed, F.lit("pending"), None).withColumn("stage", F.lit(name)).withColumn("run", F.lit(run_id).cast("long"))
    rows.write.mode("append").partitionBy("stage", "run").parquet(path)


def tallies(log: DataFrame, run_id: int) -> DataFrame:
    """stage, ok, failed of a run: a row's own status, not its side effects; skipped counts as ok."""
    own = log.where((F.col("run") == run_id) & (F.col("place") == 0) & (F.col("status") != "pending"))
    bad = F.sum((F.col("status") == "failed").cast("int"))
    return own.groupBy("stage").agg((F.count("*") - bad).alias("ok"), bad.alias("failed"))


def last_attempt(log: DataFrame) -> DataFrame:
    """The last row of each case, camera and stage, with its error."""
    order = Window.partitionBy("case_id", "camera", "stage").orderBy(F.desc("run"), F.desc("attempt"), F.desc("place"))
    return log.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
