import random

import duckdb
import pytest
from pyspark.sql import functions as F

from vantry.functions import scalars as S
from vantry.operators import catalog, manifest
from vantry.operators.ranges import overlap_join
from vantry.plans import encounters, files, scores, work  # noqa: F401  the others register their queries with the others

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(frame):
    cells = lambda r: [None if v != v else round(v, 6) if isinstance(v, float) else v for v in r]
    return sorted(map(repr, map(cells, frame[sorted(frame.columns)].astype(object).where(frame[sorted(frame.columns)].notna(), None).values.tolist())))


@pytest.mark.parametrize("name", sorted(encounters.SQL))
def test_query_equals_sql(spark, duck, name):
    assert rows(encounters.QUERIES[name](spark, SF).toPandas()) == rows(duck.execute(encounters.SQL[name]).df())


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(("value", "want"), [("'09'", "9"), ("09", "9"), ("00 la", "00 LA"), ("-7", "-7"), ("--5", None), ("000", "0"), (" x ", "X")])
def test_identifier(spark, value, want):
    assert one(spark, value, S.normalize_identifier) == want


@pytest.mark.parametrize(("value", "want"), [("04/21/2025 10:22 am", "2025-04-21T10:22:00"), ("4/1/2025 1:02 PM", "2025-04-01T13:02:00"), ("", ""), (None, ""), ("soon", "soon")])
def test_recording_start(spark, value, want):
    assert one(spark, value, S.recording_start) == want


def test_formats(spark):
    assert [one(spark, v, S.clock, "double") for v in (0.0, 3661.9, 86_400.0 + 5, None)] == ["00:00:00", "01:01:01", "00:00:05", "--:--:--"]
    assert [one(spark, v, S.speaker_label) for v in ("0", "12", "007", "0123", "Unknown_Speaker")] == ["SPEAKER_00", "SPEAKER_12", "SPEAKER_07", "SPEAKER_123", "Unknown_Speaker"]
    assert [one(spark, v, S.annotation_ms, "double") for v in (0.0005, 0.0015, 0.0025)] == [0, 2, 2]
    assert [one(spark, v, S.pitch_bucket, "double") for v in (144.9, 145.0, 185.0, 185.1)] == ["lower", "ambiguous", "ambiguous", "higher"]


def test_names(spark):
    files = spark.createDataFrame([("20260224-132704-v308933-41.mp4",), ("20260224-132704-308933-41.mp4",), ("20261324-132704-v1-2.mp4",)], "filename string")
    got = catalog.parse_names(files).collect()
    assert [r.ok for r in got] == [True, False, False] and got[0].video_time == "13:27:04" and got[0].camera == "41"


def test_camera_election(spark):
    v = spark.createDataFrame([("a", "10"), ("a", "9"), ("b", "x"), ("b", "10"), ("c", "9"), ("c", "10")], "case_id string, camera string")
    stored = spark.createDataFrame([("c", "10")], "case_id string, camera string")
    assert {r.case_id: r.camera for r in manifest.elect_camera(v, stored).collect()} == {"a": "9", "b": "10", "c": "10"}


def test_shards_cover_and_stage_reports(spark):
    v = spark.range(20).selectExpr("cast(id as string) case_id", "'1' camera", "cast(id as double) duration_s")
    parts = [{r.case_id for r in manifest.stable_shard(v, ["case_id"], k, 3).collect()} for k in range(3)]
    assert sum(map(len, parts)) == 20 and len(set().union(*parts)) == 20
    with pytest.raises(ValueError):
        manifest.stable_shard(v, ["case_id"], 2, 2)

    def work(row):
        if row["case_id"] == "3":
            raise KeyError("gone")
        return {"status": "skipped"} if row["case_id"] == "4" else None

    got = {r.case_id: r for r in manifest.run_stage(v, work).collect()}
    assert got["3"].status == "failed" and got["3"].error_type == "KeyError" and got["4"].status == "skipped" and got["5"].status == "done"


def test_word_error_rate_against_dynamic_programming(spark):
    rng = random.Random(1)
    pairs = [(" ".join(rng.choice("abcde") for _ in range(rng.randrange(1, 15))), " ".join(rng.choice("abcde") for _ in range(rng.randrange(0, 15)))) for _ in range(60)]

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, before = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        return row[-1]

    got = spark.createDataFrame(pairs, "r string, h string").select("r", "h", S.word_error_rate(F.col("r"), F.col("h")).alias("w")).collect()
    for r in got:
        assert abs(r.w - edits(r.r.split(), r.h.split()) / len(r.r.split())) < 1e-4


def plain_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_error_rates_are_those_of_whole_texts(spark, tmp_path):
    rng = random.Random(3)
    words = ["ab", "Öl,", "漢字", "c.d", "E", "ß"]
    docs = [(k, " ".join(rng.choice(words) for _ in range(rng.choice([3, 150, 400]))), rng.choice(["en", "fr"])) for k in range(12)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.choice([5, 150])))) for k in range(50)]
    docs.append((49, items[49][1] + " ab", "de"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    plain = lambda t: t.lower().replace(",", "").replace(".", "")
    pairs = {k: (plain(items[k][1]), plain(t)) for k, t, _ in docs}
    d = str(tmp_path)
    assert {r.doc_id: (r.ref, r.hyp) for r in encounters.QUERIES["text_normalize"](spark, d).collect()} == pairs
    for name, split in (("wer", str.split), ("cer", list)):
        got = {r.doc_id: r[1] for r in encounters.QUERIES[name](spark, d).collect()}
        want = {k: plain_edits(split(a), split(b)) / len(split(a)) for k, (a, b) in pairs.items()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-4 for k in want)


def test_bucketed_join_equals_nested_loop(spark):
    rng = random.Random(2)
    a = [(rng.randrange(3), k, s := rng.random() * 100, s + rng.random() * rng.choice([0, 1, 40])) for k in range(150)]
    b = [(rng.randrange(3), k, s := rng.random() * 100, s + rng.random() * rng.choice([0, 1, 40])) for k in range(150)]
    left = spark.createDataFrame(a, "k int, a int, start_s double, end_s double")
    right = spark.createDataFrame(b, "k int, b int, r_start double, r_end double")
    got = sorted((r.a, r.b) for r in overlap_join(left, right, ["k"], 7.0).collect())
    assert got == sorted((x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[2] < y[3] and y[2] < x[3])
