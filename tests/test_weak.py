"""Rules that the driver's tables do not show."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from vantry.operators import catalog, manifest, reports, signals
from vantry.sources import content, files, pose


def test_equal_durations_rank_in_many_ranges(spark):
    v = spark.range(5000).select(F.concat(F.lit("c"), F.col("id") % 700).alias("case_id"), F.col("id").cast("string").alias("camera"), F.when(F.col("id") % 2 == 0, 7.0).alias("duration_s")).repartition(6)
    same = v.withColumn("duration_s", F.lit(7.0))
    for frame in (v, same):
        ranked = manifest.interleaved_rank(frame, 3, range_rows=100)
        rows = sorted(ranked.collect(), key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(5000)) and all(r["shard"] == r["rank"] % 3 for r in rows)
        key = [(r.duration_s or 0.0, r.case_id, r.camera) for r in rows]
        assert key == sorted(key)
    assert manifest.interleaved_rank(v.limit(0), 3).count() == 0
    odd = spark.createDataFrame([(None, "1", None), ("a", None, 1.0), ("a", None, 1.0)], "case_id string, camera string, duration_s double")
    assert sorted(r["rank"] for r in manifest.interleaved_rank(odd, 2).collect()) == [0, 1, 2]


def test_election_of_long_and_negative_numbers(spark):
    cams = {"a": ["99999999999999999999", "100000000000000000000", "x"], "b": ["-2", "-10", "1", "-0"], "c": ["007", "8"], "d": ["x", "a"], "e": ["-11", "-12"], "f": ["0", "-1"]}
    v = spark.createDataFrame([(c, k) for c, ks in cams.items() for k in ks], "case_id string, camera string")
    assert {r.case_id: r.camera for r in manifest.elect_camera(v).collect()} == {"a": "99999999999999999999", "b": "-10", "c": "007", "d": "a", "e": "-12", "f": "-1"}
    wanted = spark.createDataFrame([("a",), ("z",)], "case_id string")
    assert [r.case_id for r in manifest.without_camera(wanted, v).collect()] == ["z"]


def test_media_without_numbers_or_streams(spark):
    probes = [("1", '{"format":{"duration":"N/A"},"streams":[{"codec_type":"video","avg_frame_rate":"x/1"}]}'), ("2", "{}"), ("3", None), ("4", '{"format":{"duration":"2.5"},"streams":[{"codec_type":"video","avg_frame_rate":"30000/1001","width":4,"height":2},{"codec_type":"audio"}]}')]
    got = {r.path: tuple(r)[1:] for r in catalog.media_facts(spark.createDataFrame(probes, "path string, json string")).collect()}
    assert got["1"] == (0.0, None, None, None, False) and got["2"] == got["3"] == (0.0, None, None, None, False)
    assert got["4"] == (2.5, 30000 / 1001, 4, 2, True)
    paths = spark.createDataFrame([("/r/a/b",), ("/rx/a",), (None,)], "p string").select(catalog.relative_path(F.col("p"), "/r/").alias("p"))
    assert [r.p for r in paths.collect()] == ["a/b", "/rx/a", None]


def test_sheets_known_and_blank(spark):
    cells = spark.createDataFrame([("a", 2, "Event", "x"), ("b", 2, "Event", "y"), ("c", 12, "Event", "z")], "sheet string, row_no int, label string, value string")
    cases, added, skipped = catalog.import_sheets(cells, spark.createDataFrame([("b",)], "case_id string"))
    assert {r.case_id: r.event_name for r in cases.collect()} == {"a": "x", "c": ""}
    assert sorted(r.case_id for r in added.collect()) == ["a", "c"] and [r.case_id for r in skipped.collect()] == ["b"]


def test_boundary_ties_are_exact(spark):
    words = spark.createDataFrame([("a", k, 100 + 0.1 * k, 100.5) for k in range(4)], "case_id string, pos int, start_s double, end_s double")
    gold = spark.createDataFrame([("a", k, 100 + 0.1 * k + 1e-6 * (k == 0), 100.5) for k in range(4)] + [("a", 9, None, 1.0)], "case_id string, pos int, start_s double, end_s double")
    (r,) = signals.boundary_error(words, gold, ["case_id", "pos"]).collect()
    assert (r.n, r.mean_s, r.median_s) == (8, 0.0, 0.0)  # 1 / 8 of a microsecond
    more = gold.withColumn("start_s", F.col("start_s") + 1e-6 * F.when(F.col("pos") < 3, 1).otherwise(0))
    (r,) = signals.boundary_error(words, more, ["case_id", "pos"]).collect()
    assert (r.mean_s, r.median_s) == (1e-6, 0.0)  # a tie of four halves, up


def test_one_case_again_leaves_the_others(spark, tmp_path):
    schema = f"case_id string, camera string, engine string, model string, {files.TRANSCRIPT}"
    one = lambda case, camera, word: (case, camera, "e", "m", [(word, 0.0, 1.0, None)], None)
    files.write_transcripts(spark.createDataFrame([one("a", "1", "x"), one("a", "2", "y"), one("b", "1", "z")], schema), str(tmp_path / "t"))
    files.write_transcripts(spark.createDataFrame([one("a", "1", "new")], schema), str(tmp_path / "t"))
    got = {(r.case_id, r.camera): r.word for r in files.read_transcript_words(spark, str(tmp_path / "t")).collect()}
    assert got == {("a", "1"): "new", ("a", "2"): "y", ("b", "1"): "z"}


def test_lines_of_a_case_keep_their_order(spark, tmp_path):
    rng = random.Random(0)
    rows = [(f"c{c}", k, f"line {k} é") for c in range(7) for k in range(60)] + [(None, 0, "lost"), ("c8", 0, "")]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "case_id string, idx long, line string").repartition(5)
    files.write_lines(frame, str(tmp_path / "l"))
    files.write_lines(spark.createDataFrame([("c3", 0, "again")], "case_id string, idx long, line string"), str(tmp_path / "l"))
    got = sorted((r.case_id, r.idx, r.line) for r in files.read_lines(spark, str(tmp_path / "l")).collect())
    assert got == sorted([(c, k, t) for c, k, t in rows if c not in (None, "c3")] + [("c3", 0, "again")])


def test_rttm_without_turns(spark, tmp_path):
    (tmp_path / "a.rttm").write_text(";; nothing\n")
    (tmp_path / "b.rttm").write_text("SPEAKER one 1 0.5 1.0 <NA> <NA> A <NA> <NA>\n")
    assert [r.file.split("/")[-1] for r in files.unread_rttm(spark, str(tmp_path)).collect()] == ["a.rttm"]
    assert files.read_rttm(spark, str(tmp_path)).count() == 1
    with pytest.raises(Exception, match="has no turns"):
        files.read_rttm(spark, str(tmp_path), strict=True).collect()


def test_seed_fills_an_empty_map_alone(spark, tmp_path):
    (tmp_path / "one.csv").write_text("room,camera_id\n'01', '4'\n02,'4'\n")
    (tmp_path / "two.csv").write_text("room,camera_id\n9,9\n")
    paths = [str(tmp_path / n) for n in ("none.csv", "one.csv", "two.csv")]
    empty = spark.createDataFrame([], "camera_id string, room string")
    filled = files.seeded(empty, paths)
    assert [tuple(r) for r in filled.collect()] == [("4", "2")]
    assert [tuple(r) for r in files.seeded(filled, paths[2:]).collect()] == [("4", "2")]
    assert files.seeded(empty, paths[:1]).count() == 0


def test_fingerprints_of_small_and_large_files(spark, tmp_path):
    data = {"a.bin": b"", "sub/b.bin": bytes(range(256)) * 9, "sub/c.bin": random.Random(1).randbytes(3_000_000)}
    for name, held in data.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(held)
    for limit in (0, 1000, 1 << 30):
        got = {r.path.split(f"{tmp_path}/")[1]: (r.length, r.sha256) for r in content.fingerprints(spark, str(tmp_path), limit).collect()}
        assert got == {n: (len(h), hashlib.sha256(h).hexdigest()) for n, h in data.items() if h}


def test_tensors_to_rows_and_back(spark, tmp_path):
    point = lambda s, t: [[float(s), float(t + k)] for k in range(3)]
    rows = [("v", s, t, point(s, t), [0.5, 0.25, float(t)]) for s, t in [(0, 0), (1, 0), (0, 5), (5, 2)]] + [("w", 0, 1, point(0, 1), [0.0, 0.0, 1.0])]
    frame = pose.with_gaps_filled(spark.createDataFrame(rows, pose.ROWS), 4, 3, 2)
    key = lambda f: sorted(map(str, f.select("video", "slot", "frame", "keypoint", "score").collect()))
    want = key(frame)
    assert len(want) == 4 * 6 + 4 * 2
    assert frame.where("slot = 3 and frame = 4 and video = 'v'").first().keypoint == [[0.0, 0.0]] * 3
    pose.write_rows(frame, str(tmp_path / "p"))
    assert key(pose.read_rows(spark, str(tmp_path / "p"))) == want
    for n in (1, 4, 100):
        assert key(pose.rows_of_blocks(pose.blocks_of(frame, n), n)) == want
    whole = pose.entries_of(frame, F.lit(480), F.lit(640))
    assert {(r.frame_dir, r.total_frames, tuple(r.img_shape), len(r.keypoint), len(r.keypoint_score[3])) for r in whole.collect()} == {("v", 6, (480, 640), 4, 6), ("w", 2, (480, 640), 4, 2)}
    pose.write_json(whole, str(tmp_path / "j"))
    assert key(pose.rows_of(pose.read_json(spark, str(tmp_path / "j")))) == want
    bare = spark.createDataFrame([("x", 1, None, 0, [[[[1.0, 2.0]]]], None), ("y", 0, None, 0, None, None)], pose.ENTRY)
    assert [(r.video, r.score) for r in pose.rows_of(bare).collect()] == [("x", None)]


def test_series_of_fewer_frames_than_the_window(spark):
    pts = lambda x: [[0.0, 0.0]] * 5 + [[0.0, 0.0], [1.0, x]]
    frame = spark.createDataFrame([("a", k, pts(0.0 if k else 1.0)) for k in range(3)] + [("b", k, pts(1.0)) for k in range(5)], "video string, frame long, points array<array<double>>")
    got = sorted((r.video, r.frame, round(r.angle, 6)) for r in signals.facing_series(frame).collect())
    assert got == [("a", 0, 9.0), ("a", 1, 9.0), ("a", 2, 9.0), ("b", 0, 45.0)]


def test_gold_and_segments(spark):
    rows = [("a", "LEARNER", 1000, 2500, " hi "), ("a", "OUTSIDE_ROOM", 500, 900, "cart"), ("a", "PATIENT", 1000, 2000, "oh"), ("a", "PATIENT", 3000, 3100, " "), ("b", "OUTSIDE_ROOM", 0, 10, "x")]
    frame = spark.createDataFrame(rows, "case_id string, tier string, start_ms long, end_ms long, value string")
    assert sorted(map(tuple, signals.gold_lines(frame).collect())) == [("a", 0, "oh"), ("a", 1, "hi")]
    assert {r.speaker for r in signals.gold_turns(frame).where("start_s = 0.5").collect()} == {"OTHER"} and signals.gold_turns(frame).count() == 5
    turns = spark.createDataFrame([("a", float(k), k + 0.5, "s") for k in range(730)], "case_id string, start_s double, end_s double, speaker string")
    labels = {r.idx: (r.label, r.segment) for r in signals.turn_segments(turns).collect()}
    assert [labels[k][0] for k in (0, 25, 26, 51, 52, 701, 702, 729)] == ["A", "Z", "AA", "AZ", "BA", "ZZ", "AAA", "ABB"] and labels[1][1] == "1.000-1.500"


def test_texts_of_segments_or_words(spark):
    w = lambda *ws: [(x, 0.0, 1.0, None) for x in ws]
    rows = [(1, w("r"), [(" a ", w("x")), ("b", None)]), (2, None, [("a", w("x ")), (None, w("y"))]), (3, w("r", None), [(None, w("y"))]), (4, None, []), (5, None, None), (6, None, [(None, None)])]
    got = {r.id: r.hypothesis for r in reports.transcript_text(spark.createDataFrame(rows, f"id int, {files.TRANSCRIPT}")).collect()}
    assert got == {1: "a b", 2: "x y", 3: "r ", 4: "", 5: "", 6: ""}


def test_not_a_number_in_every_track(spark):
    nan = float("nan")
    rows = [("a", 0.01, *[nan] * 7), ("a", 1.0, *[None] * 7), ("a", 2.0, *[5.0] * 7)]
    frame = spark.createDataFrame(rows, "case_id string, t double, " + ", ".join(f"{c} double" for c in signals.ACOUSTIC))
    first, second, third = sorted(signals.acoustic_frames(frame, 0.04).collect(), key=lambda r: r.frame)
    assert first.pitch is None and first.harmonicity is None and all(first[c] != first[c] for c in signals.ACOUSTIC if c not in ("pitch", "harmonicity"))
    assert all(second[c] is None for c in signals.ACOUSTIC) and all(third[c] == 5.0 for c in signals.ACOUSTIC) and first.start_s == 0.0
