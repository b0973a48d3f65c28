import pytest
from pyspark.sql import functions as F

from vantry.operators import stages


def registry():
    def asr(row):
        if row["camera"] == "7":
            raise OSError("no sound")
        return {"asr_model": "whisper/medium"}

    return stages.Registry(
        stages.Stage("audio", lambda row: {"audio_path": f"{row['case_id']}.wav"}),
        stages.Stage("asr", asr, needs="audio", effects=(("diarize", "done"),)),
        stages.Stage("diarize", lambda row: None),
        stages.Stage("pose", lambda row: {"status": "skipped"} if row["camera"] == "10" else None, per_camera=True),
    )


REGISTRY = registry()


def videos(spark):
    rows = [("a", "9", "pending"), ("a", "10", "pending"), ("b", "7", "pending"), ("b", "x", "done"), ("c", "1", "failed")]
    return spark.createDataFrame(rows, "case_id string, camera string, pose_status string")


def told(frame, *columns):
    return {(r.case_id, r.camera): tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in frame.collect()}


def test_stages_by_name_with_side_effects(spark, tmp_path):
    path, v = str(tmp_path / "log"), videos(spark)
    with pytest.raises(KeyError):
        stages.run(REGISTRY, "elan", v, path, 1)
    with pytest.raises(ValueError):
        REGISTRY.add(stages.Stage("asr", dict))
    now = stages.run(REGISTRY, "asr", v, path, 1)
    assert told(now, "asr_status") == {("a", "9"): "failed", ("a", "10"): "skipped", ("b", "7"): "failed", ("b", "x"): "skipped", ("c", "1"): "failed"}
    stages.run(REGISTRY, "audio", v, path, 2, shares=3)
    stages.retry(v, "asr", path, 3)
    now = stages.run(REGISTRY, "asr", v, path, 4)
    assert told(now, "asr_status", "diarize_status", "asr_attempts") == {
        ("a", "9"): ("done", "done", 2), ("a", "10"): ("skipped", "pending", 1), ("b", "7"): ("failed", "pending", 2), ("b", "x"): ("skipped", "pending", 1), ("c", "1"): ("done", "done", 2),
    }
    assert told(now, "updates")[("a", "9")] == {"audio_path": "a.wav", "asr_model": "whisper/medium"}
    now = stages.run(REGISTRY, "diarize", v, path, 5)
    assert told(now, "diarize_status") == {("a", "9"): "done", ("a", "10"): "skipped", ("b", "7"): "done", ("b", "x"): "skipped", ("c", "1"): "done"}
    now = stages.run(REGISTRY, "pose", v, path, 6)
    assert told(now, "pose_status") == {("a", "9"): "done", ("a", "10"): "skipped", ("b", "7"): "done", ("b", "x"): "done", ("c", "1"): "failed"}
    log = stages.read_log(spark, path)
    assert {(r.stage, r.ok, r.failed) for r in stages.tallies(log, 4).collect()} == {("asr", 2, 1)}
    error = stages.last_attempt(log).where("camera = '7' and stage = 'asr'").first()
    assert (error.error_type, error.error_msg, error.attempt) == ("OSError", "OSError: no sound", 2)


def test_a_run_that_stops_and_one_that_does_not_agree(spark, tmp_path):
    v = spark.range(40).select(F.col("id").cast("string").alias("case_id"), F.lit("1").alias("camera"))
    whole = told(stages.run(REGISTRY, "audio", v, str(tmp_path / "a"), 1, shares=4), "audio_status", "audio_attempts", "updates")
    path = str(tmp_path / "b")
    real, calls = stages.read_log, []

    def stops(session, place):
        calls.append(place)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return real(session, place)

    stages.read_log = stops
    try:
        with pytest.raises(RuntimeError):
            stages.run(REGISTRY, "audio", v, path, 1, shares=4)
    finally:
        stages.read_log = real
    half = stages.read_log(spark, path).count()
    assert 0 < half < 40
    assert told(stages.run(REGISTRY, "audio", v, path, 1, shares=4), "audio_status", "audio_attempts", "updates") == whole
    assert stages.read_log(spark, path).count() == 40
    assert stages.run(REGISTRY, "audio", v, path, 2).where("audio_attempts <> 1").count() == 0 and stages.read_log(spark, path).count() == 40
