import hashlib

import pytest

from vantry.operators import quality
from vantry.sources import content, files


def test_camera_rooms_last_row_wins(spark, tmp_path):
    (tmp_path / "rooms.csv").write_text("room,camera_id\n'01',41\n 02 ,'41'\n00 la,7\n")
    got = {r.camera_id: r.room for r in files.read_camera_rooms(spark, str(tmp_path)).collect()}
    assert got == {"41": "2", "7": "00 LA"}


def test_rttm_keeps_the_first_recording_of_a_file(spark, tmp_path):
    (tmp_path / "a.rttm").write_text("SPEAKER one 1 0.500 1.250 <NA> <NA> A <NA> <NA>\n;; note\nSPEAKER two 1 9.0 1.0 <NA> <NA> B <NA> <NA>\n")
    whole = files.read_rttm(spark, str(tmp_path))
    first = files.read_rttm(spark, str(tmp_path), first_only=True)
    assert whole.count() == 2
    assert [tuple(r) for r in first.collect()] == [("one", 0.5, 1.75, "A")]


def test_transcripts_prefer_words_and_replace_their_folder_only(spark, tmp_path):
    def one(case, model, root, inner):
        words = lambda ws: [(w, 0.0, 1.0, None) for w in ws]
        schema = f"case_id string, {files.TRANSCRIPT}, camera string, engine string, model string"
        return spark.createDataFrame([(case, words(root) if root is not None else None, [(None, words(inner))], "1", "e", model)], schema)

    path = str(tmp_path / "t")
    for case, model, root, inner in (("c", "m1", [], ["x", "y"]), ("c", "m2", ["z"], ["x"]), ("d", "m1", None, ["v"])):
        files.write_transcripts(one(case, model, root, inner), path)
    got = sorted((r.case_id, r.model, r.idx, r.word) for r in files.read_transcript_words(spark, path).collect())
    assert got == [("c", "m1", 0, "x"), ("c", "m1", 1, "y"), ("c", "m2", 0, "z"), ("d", "m1", 0, "v")]


def test_consent_and_sweep(spark):
    refs = spark.createDataFrame([("a", "x"), ("b", " "), ("c", None)], "case_id string, consent_ref string")
    assert {r.case_id: r.accepted for r in quality.consent_gate(refs).collect()} == {"a": True, "b": False, "c": False}
    runs = spark.createDataFrame([("w", "s", 1.0), ("w", "l", 3.0), ("f", "s", 2.0)], "engine string, model string, wer double")
    got = sorted((r.axis, r.engine or r.model, r.n_values) for r in quality.one_axis_sweep(runs, ["engine", "model"], "wer").collect())
    assert got == [("engine", "s", 2), ("model", "w", 2)]


def test_cases_share_files(spark, tmp_path):
    """Files grow with the bytes, not with the cases; nulls and blanks are keys of a transcript like others."""
    lines = spark.range(300).selectExpr("cast(id as string) case_id", "0L idx", "concat('a\n', id) line").repartition(3)
    files.write_lines(lines, str(tmp_path / "l"))
    assert len(list((tmp_path / "l").rglob("part-*"))) <= 3
    assert files.read_lines(spark, str(tmp_path / "l")).where("case_id = '7'").orderBy("idx").collect() == [("7", 0, "a"), ("7", 1, "7")]
    schema = f"case_id string, camera string, engine string, model string, {files.TRANSCRIPT}"
    one = lambda case, camera, word: (case, camera, "e", "m", [(word, 0.0, 1.0, None)], None)
    files.write_transcripts(spark.createDataFrame([one("a", None, "x"), one("a", "", "y"), one(None, None, "z")], schema), str(tmp_path / "t"))
    files.write_transcripts(spark.createDataFrame([one("a", None, "new")], schema), str(tmp_path / "t"))
    got = {(r.case_id, r.camera, r.word) for r in files.read_transcript_words(spark, str(tmp_path / "t")).collect()}
    assert got == {("a", None, "new"), ("a", "", "y"), (None, None, "z")}


def test_first_recording_of_each_text(spark):
    turn = lambda name, at: f"SPEAKER {name} 1 {at} 1.0 <NA> <NA> A <NA> <NA>"
    lines = spark.createDataFrame([("x", 1, turn("x2", 3.0)), ("x", 0, turn("x1", 2.0)), ("y", 0, turn("y", 1.0))], "case_id string, idx long, line string")
    assert sorted((r.case_id, r.start_s) for r in files.rttm_of_lines(lines, first_only=True, strict=True).collect()) == [("x1", 2.0), ("y", 1.0)]
    none = spark.createDataFrame([("z", 0, ";; nothing")], lines.schema)
    with pytest.raises(Exception, match="has no turns"):
        files.rttm_of_lines(lines.union(none), strict=True).collect()


def test_bundle_fingerprints(spark, tmp_path):
    held = {"a": b"", "b": bytes(range(256)), "c": bytes(range(250)) * 40, "d": b"x" * 100, "e": b"y" * 101, "f": None}
    spread = spark.createDataFrame([(p, None if h is None else bytearray(h)) for p, h in held.items()], "path string, content binary").repartition(3)
    content.write_bundle(spread, str(tmp_path / "b"), most=100)
    got = {r.path: (r.length, r.sha256) for r in content.bundle_fingerprints(spark, str(tmp_path / "b")).collect()}
    assert got == {p: (len(h), hashlib.sha256(h).hexdigest()) for p, h in held.items() if h is not None}
    assert len(list((tmp_path / "b").rglob("part-*"))) <= 3
