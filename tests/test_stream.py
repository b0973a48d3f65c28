import json
import os

from vantry.streaming import incremental


def write(path, name, names):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.json", "w") as f:
        f.writelines(json.dumps({"filename": n}) + "\n" for n in names)


def name(k, camera=41):
    return f"20260224-13{k // 60:02d}{k % 60:02d}-v{k}-{camera}.mp4"


def follow(spark, tmp):
    rooms = spark.createDataFrame([("41", "09")], "camera_id string, room_number string")
    cases = spark.createDataFrame([("c1", "9", "02/24/2026 1:00 pm"), ("c2", "9", "02/24/2026 1:01 pm"), ("c3", "9", "02/24/2026 1:01 pm")], "case_id string, room_number string, recording_start string")
    stream = spark.readStream.schema("filename string").option("maxFilesPerTrigger", 1).json(f"{tmp}/in")
    incremental.incremental_catalog(stream, rooms, cases, f"{tmp}/out", f"{tmp}/offsets")
    return sorted((r.filename, r.status) for r in incremental.read_catalog(spark, f"{tmp}/out").collect())


def test_two_batches_equal_one_and_names_count_once(spark, tmp_path):
    write(f"{tmp_path}/a/in", "1", [name(1), name(2, 7), name(1), None])
    write(f"{tmp_path}/a/in", "2", [name(61), name(2, 7), "junk"])
    write(f"{tmp_path}/b/in", "1", [name(1), name(2, 7), name(61), "junk"])
    both = follow(spark, f"{tmp_path}/a")
    assert both == follow(spark, f"{tmp_path}/b") == [(name(1), "matched"), (name(2, 7), "no_room"), (name(61), "ambiguous")]
    write(f"{tmp_path}/a/in", "3", [name(1), name(180)])  # the next start knows what was registered
    assert follow(spark, f"{tmp_path}/a") == sorted([*both, (name(180), "no_match")])


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    write(f"{tmp_path}/in", "1", [name(1), name(2)])
    write(f"{tmp_path}/in", "2", [name(3), name(1)])
    whole = follow(spark, tmp_path)
    last = max((f for f in os.listdir(f"{tmp_path}/offsets/commits") if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):
        os.remove(f"{tmp_path}/offsets/commits/{f}")  # as if the driver was lost before it noted the batch
    assert follow(spark, tmp_path) == whole and len(whole) == 3


def test_a_batch_does_not_read_what_is_registered(spark, tmp_path):
    write(f"{tmp_path}/in", "1", [name(k) for k in range(600)])
    follow(spark, tmp_path)
    for folder, _, found in os.walk(f"{tmp_path}/out"):
        for f in found:
            os.remove(f"{folder}/{f}")  # a batch that read its sink would take all names for new ones
    write(f"{tmp_path}/in", "2", [name(3), name(700)])
    assert [f for f, _ in follow(spark, tmp_path)] == [name(700)]
