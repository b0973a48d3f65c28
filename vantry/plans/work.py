"""Work lists, lookups, checks and scores over encounters."""

from __future__ import annotations

from pyspark.sql import functions as F

from vantry.functions import scalars as S
from vantry.operators import catalog, manifest, quality, reports, signals, stages
from vantry.plans.encounters import DET, MATCH, PITCH, TURNS, VIDEOS, WORDS, case_match, query
from vantry.sources import files
from vantry.sources import tables as T


@query("select event_id, case when event_id%5=0 then 'Unknown_Speaker' when event_id%5=1 then 'Dr 7' else 'SPEAKER_'||lpad(cast(user_id as varchar),cast(greatest(2,length(cast(user_id as varchar))) as int),'0') end label from events")
def speaker_label_format(spark, d):
    spelled = F.lpad(F.col("user_id").cast("string"), F.length(F.col("user_id").cast("string")) + F.col("event_id").cast("int") % 3, F.lit("0"))
    name = F.when(F.col("event_id") % 5 == 0, "Unknown_Speaker").when(F.col("event_id") % 5 == 1, "Dr 7").otherwise(spelled)
    return T.table(spark, d, "events").select("event_id", S.speaker_label(name).alias("label"))


@query(f"with {VIDEOS} select case_id, camera, duration_s from v where pose_status='pending' and case_id=(select min(case_id) from v where pose_status='pending')")
def one_case_filter(spark, d):
    todo = T.videos(spark, d).where("pose_status = 'pending'").select("case_id", "camera", "duration_s")
    return manifest.only_case(todo, todo.agg(F.min("case_id")).first()[0])


@query(f"with {VIDEOS} select case_id, camera, duration_s from v where pose_status='pending'")
def shortest_first(spark, d):
    return manifest.shortest_first(T.videos(spark, d).where("pose_status = 'pending'").select("case_id", "camera", "duration_s"))


@query(f"with {VIDEOS} select case_id, camera from v")
def ordered_listing(spark, d):
    return catalog.listing(T.videos(spark, d).select("case_id", "camera"), ["case_id", "camera"])


@query("with r as (select distinct cast(user_id as varchar) camera_id, lpad(cast(user_id%30 as varchar),2,'0') room_number from events where user_id%11<>0), k as (select distinct cast(user_id as varchar) camera_id from events) select camera_id, room_number from k left join r using (camera_id)")
def point_lookup(spark, d):
    wanted = T.table(spark, d, "events").select(F.col("user_id").cast("string").alias("camera_id"))
    return catalog.lookup(T.camera_rooms(spark, d), wanted, ["camera_id"])


@query(f"with {VIDEOS} select case_id, camera, c_name case_name, duration_s/60 duration_min from v join customer on c_custkey=cast(case_id as bigint)")
def longest_shortest_inventory(spark, d):
    cases = T.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("case_id"), F.col("c_name").alias("case_name"))
    videos = T.videos(spark, d)
    return quality.by_duration(quality.registered_inventory(cases, videos, videos))


@query(f"with {TURNS} select case_id, cast(s as double) start_s, cast(e as double) end_s, who speaker, length(case_id)%2=0 cached from t")
def diarization_reuse(spark, d):
    turns = T.turns(spark, d).select("case_id", "start_s", "end_s", "speaker")
    return manifest.reuse(turns.select("case_id").distinct(), turns.where(F.length("case_id") % 2 == 0), ["case_id"], lambda todo: turns.join(todo, "case_id", "left_semi"))


@query(f"with {PITCH} select p.case_id, speaker, round(median(hz),6) median_hz, count(*) n_frames, case when median(hz)<145 then 'lower' when median(hz)>185 then 'higher' else 'ambiguous' end bucket from p join pt on p.case_id=pt.case_id and t>=s and t<e where hz>0 group by 1,2 having count(*)>=10")
def speaker_stats_export(spark, d):
    path = files.new_path(spark, "speakers")
    files.write_speaker_stats(signals.speaker_pitch(T.pitch(spark, d), T.pitch_turns(spark, d)).withColumn("median_hz", F.round("median_hz", 6)), path)
    return files.read_speaker_stats(spark, path)


@query(f"""with {VIDEOS}, u as (select case_id, case when length(camera)%4=0 then camera||'z' else camera end camera, case when length(case_id)%3=0 then null when asr_status='failed' then 'broken' else asr_status end status from v)
 select case_id, camera, status, 'status' reason from u where status is null or status not in ('pending','done','failed','skipped') union all
 select case_id, camera, status, 'key' from u where status in ('pending','done','failed','skipped') and not exists (select 1 from v where v.case_id=u.case_id and v.camera=u.camera)""")
def state_update_check(spark, d):
    v = T.videos(spark, d)
    camera = F.when(F.length("camera") % 4 == 0, F.concat("camera", F.lit("z"))).otherwise(F.col("camera")).alias("camera")
    status = F.when(F.length("case_id") % 3 == 0, None).when(F.col("asr_status") == "failed", "broken").otherwise(F.col("asr_status")).alias("status")
    return manifest.bad_updates(v.select("case_id", camera, status), v)


@query(f"with {VIDEOS}, n as (select case_id, count(*) c from v group by 1) select case_id, camera, c=1 and cast(case_id as bigint)%3<>0 added from v join n using (case_id)")
def insert_if_absent(spark, d):
    rows = T.videos(spark, d).select("case_id", "camera")
    known = T.table(spark, d, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").cast("string").alias("case_id"))
    added, refused = catalog.insert_if_absent(known, rows, ["case_id"])
    return added.withColumn("added", F.lit(True)).unionByName(refused.withColumn("added", F.lit(False)))


STALE = "case when substr(filename,1,8)>='20240901' then 'matched' when substr(filename,1,8)>='20240401' then 'no_room' end"


@query(MATCH + f""" select filename, case when {STALE}='matched' then 'matched' else status end status, case when {STALE}='matched' then 'OLD' else case_id end case_id,
 case when {STALE}='matched' then '1' else room end room, case when {STALE}='matched' then '' else candidates end candidates from m""")
def match_cache_merge(spark, d):
    """All matches again, from a cache that is out of date: its matched rows stay, its others are matched anew."""
    day = F.substring("filename", 1, 8)
    old = T.recordings(spark, d).withColumn("status", F.when(day >= "20240901", "matched").when(day >= "20240401", "no_room")).where("status is not null")
    hit = F.col("status") == "matched"
    cached = old.select("filename", "status", F.when(hit, "OLD").alias("case_id"), F.when(hit, "1").otherwise("").alias("room"), F.lit("").alias("candidates"))
    return catalog.rematch(cached, T.recordings(spark, d), T.camera_rooms(spark, d), T.cases(spark, d))


@query(rf"""with {WORDS}, k as (select case_id, trim(regexp_replace(lower(word),'\p{{P}}','','g')) word, (pos+turn)%7=3 heard from w), s as (select * from k where word<>''),
 r as (select case_id, count(*) n, count(*) filter (heard) gone, sum(length(word)+1)-1 chars from s group by 1), c as (select conv_id, count(*) turns from conversations group by 1)
 select '2026-01-0'||(1+conv_id%3)||'T00:00:00' as timestamp, case_id, 'e'||(conv_id%2) engine, 'small' model, sha256(case_id) audio_sha256, round(gone/n::double,4) wer, round(gone/chars::double,4) cer,
 round(turns*1.25,1) wall_s, sha1('run'||case_id) git_commit, 'host-'||(conv_id%4) machine, 'turns: '||turns notes from r join c on case_id=cast(conv_id as varchar)""")
def benchmark_run_row(spark, d):
    """A run for every conversation, whose words an engine hears with some replaced; appended to a log by day, and read back."""
    c = T.table(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns")).withColumn("case_id", F.col("conv_id").cast("string"))
    name = [F.concat(F.lit("e"), F.col("conv_id") % 2).alias("engine"), F.lit("small").alias("model")]
    w = T.words(spark, d, dealt=True).where(F.col("word").rlike(r"[^\p{P}\s]"))  # what normalising leaves something of
    heard = F.when((F.col("pos") + F.col("turn")) % 7 == 3, F.concat("word", F.lit("~!"))).otherwise(F.col("word")).alias("heard")
    texts = w.groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("turn", "pos", "word", heard))).alias("ws"))
    text = lambda k: F.array_join(F.transform("ws", lambda x: x[k]), " ").alias("text")
    known = [F.concat(F.lit("2026-01-0"), 1 + F.col("conv_id") % 3, F.lit("T00:00:00")).alias("timestamp"), F.sha2(F.col("case_id").cast("binary"), 256).alias("audio_sha256"), (F.col("turns") * 1.25).cast("double").alias("wall_s")]
    known += [F.sha1(F.concat(F.lit("run"), "case_id").cast("binary")).alias("git_commit"), F.concat(F.lit("host-"), F.col("conv_id") % 4).alias("machine"), F.concat(F.lit("turns: "), "turns").alias("notes")]
    hyps = texts.join(c, "case_id").select("case_id", *name, text("heard"))
    rows = quality.benchmark_runs(texts.select("case_id", text("word")), hyps, c.select("case_id", *name, *known))
    path = files.new_path(spark, "bench")
    files.append_run_log(rows.withColumn("run_date", F.substring("timestamp", 1, 10)), path)  # every run is scored once, whatever its day
    return files.read_run_log(spark, path)


@query(f"""with {WORDS}, b as (select case_id, unnest([(pos%5)*10000, (pos%3)*20000]) x from w) select case_id, count(*) n, ((2*sum(x)+count(*))//(2*count(*)))/1e6 mean_s, floor((2*median(x)+1)/2)/1e6 median_s from b group by 1""")
def boundary_error(spark, d):
    gold = T.words(spark, d)
    moved = gold.withColumn("start_s", F.col("start_s") + F.col("pos") % 5 * 0.01).withColumn("end_s", F.col("end_s") - F.col("pos") % 3 * 0.02)
    return signals.boundary_error(moved, gold, ["case_id", "turn", "pos"])


@query("""with e as (select user_id%10 as pair, cast(floor((epoch(ts)-epoch(timestamp '2024-01-01'))/86400) as bigint) i, cast(sum(cast(value as double)) as double) x from events group by 1,2),
 b as (select a.pair, lag, round(corr(a.x, c.x + c.i%3),6) r from e a, (select unnest(range(-4,5)) lag), e c where c.pair=a.pair and a.i=c.i-2+lag group by 1,2)
 select pair, cast(arg_max(lag, struct_pack(r:=r, back:=-lag)) as int) lag, max(r) r from b group by 1""")
def feed_lag(spark, d):
    day = F.floor((F.col("ts").cast("timestamp").cast("double") - F.lit("2024-01-01").cast("timestamp").cast("double")) / 86400).alias("i")
    left = T.table(spark, d, "events").groupBy((F.col("user_id") % 10).alias("pair"), day).agg(F.sum(F.col("value").cast("double")).alias("x"))
    right = left.select("pair", (F.col("i") - 2).alias("i"), (F.col("x") + F.col("i") % 3).alias("x"))
    return signals.feed_lag(left, right, 4)


@query(f"""with {VIDEOS}, e as (select case_id, camera c from (select *, row_number() over (partition by case_id order by case when regexp_full_match(camera,'-?[0-9]+') then 0 else 1 end, try_cast(camera as bigint), camera) n from v) where n=1),
 s as (select v.case_id, camera, c=camera own, duration_s is not null heard, pose_status from v join e using (case_id))
 select case_id, camera, case when not own then 'skipped' when heard then 'done' else 'failed' end audio_status, case when not own then 'skipped' when heard then 'done' else 'failed' end asr_status,
 case when own and heard then 'done' else 'pending' end diarize_status, case when own and heard then 'engine/small' end asr_model, case when own and not heard then 2 else 1 end asr_attempts,
 case when pose_status='pending' then 'done' else pose_status end pose_status, case when pose_status='pending' then 1 else 0 end pose_attempts from s""")
def stage_registry(spark, d):
    """State after audio, ASR with its side effects, a second try of what failed, and pose, folded from the log of all runs."""

    def audio(row: dict) -> dict:
        if row["duration_s"] is None or row["duration_s"] != row["duration_s"]:
            raise ValueError("no duration")
        return {"audio_path": row["camera"] + ".wav"}

    registry = stages.Registry(
        stages.Stage("audio", audio),
        stages.Stage("asr", lambda row: {"asr_model": "engine/small"}, needs="audio", effects=(("diarize", "done"),)),
        stages.Stage("pose", lambda row: None, per_camera=True),
    )
    videos, log = T.videos(spark, d).select("case_id", "camera", "duration_s", "pose_status"), files.new_path(spark, "status")
    stages.run(registry, "audio", videos, log, 1)
    stages.run(registry, "asr", videos, log, 2)
    stages.retry(videos, "asr", log, 3)
    stages.run(registry, "asr", videos, log, 4)
    now = stages.run(registry, "pose", videos, log, 5)
    return now.select("case_id", "camera", "audio_status", "asr_status", "diarize_status", F.col("updates").getItem("asr_model").alias("asr_model"), "asr_attempts", "pose_status", "pose_attempts")


@query(f"with {VIDEOS} select case_id, camera, 'e'||(length(camera)%2) engine, 'small' model, asr_status='done' and length(camera)%2=length(case_id)%2 ready from v where elan_status='pending'")
def transcript_prerequisite(spark, d):
    """Work of the ELAN stage, by case, camera, engine and model: ready where that very transcript was made."""
    v = T.videos(spark, d)
    keys = ["case_id", "camera", "engine", "model"]
    engine = lambda c: F.concat(F.lit("e"), F.length(c) % 2).alias("engine")
    done = v.where("asr_status = 'done'").select("case_id", "camera", engine("case_id"), F.lit("small").alias("model"))
    return reports.prerequisite(v.where("elan_status = 'pending'").select("case_id", "camera", engine("camera"), F.lit("small").alias("model")), done, keys)


@query(f"""with {VIDEOS}, e as (select case_id, camera from (select *, row_number() over (partition by case_id order by case when regexp_full_match(camera,'-?[0-9]+') then 0 else 1 end, try_cast(camera as bigint), camera) n from v) where n=1),
 k as (select case_id, max(camera) kept from v where cast(case_id as bigint)%3=0 group by 1) select e.case_id, coalesce(kept, camera) camera from e left join k on k.case_id=e.case_id""")
def camera_election_kept(spark, d):
    """Cameras of all cases where some have a stored choice."""
    v = T.videos(spark, d)
    return manifest.elect_camera(v, v.where("cast(case_id as bigint) % 3 = 0").groupBy("case_id").agg(F.max("camera").alias("camera")))


@query(f"with {VIDEOS} select cast(c_custkey as varchar) case_id from customer where c_custkey not in (select o_custkey from orders where o_orderstatus='F')")
def cases_without_camera(spark, d):
    wanted = T.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("case_id"))
    return manifest.without_camera(wanted, T.videos(spark, d).where("pose_status = 'done'"))


@query("select cast(c_custkey as varchar) case_id, c_custkey%4<>0 added from customer")
def case_sheet_lists(spark, d):
    """Which cases a workbook adds, and which it skips as they are known."""
    known = T.table(spark, d, "customer").where("c_custkey % 4 = 0").select(F.col("c_custkey").cast("string").alias("case_id"))
    _, added, skipped = catalog.import_sheets(T.sheet_cells(spark, d), known)
    return added.withColumn("added", F.lit(True)).unionByName(skipped.withColumn("added", F.lit(False)))


@query("select p_partkey part, case when p_partkey%3=0 then '/mnt/' else 'raw/' end||p_name||'.mp4' path from part")
def media_path(spark, d):
    p = T.table(spark, d, "part")
    base = F.when(F.col("p_partkey") % 3 == 0, "/mnt/").otherwise("/srv/data/raw/")
    return p.select(F.col("p_partkey").alias("part"), catalog.relative_path(F.concat(base, "p_name", F.lit(".mp4")), "/srv/data").alias("path"))


@query("select l_orderkey run, l_linenumber line, l_returnflag engine, round(l_quantity/l_extendedprice::double,3) realtime_factor, cast(round(cast(l_quantity as decimal(18,2)),2) as double) as seconds, cast(round(cast(l_extendedprice as decimal(18,2)),1) as double) audio_s from lineitem")
def realtime_rows(spark, d):
    rows = T.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("run"), F.col("l_linenumber").alias("line"), F.col("l_returnflag").alias("engine"), F.col("l_quantity").cast("double").alias("seconds"), F.col("l_extendedprice").cast("double").alias("audio_s"))
    return reports.realtime_rows(rows)


@query("with s as (select l_returnflag engine, l_linestatus model, cast(l_linenumber as varchar) accel, cast(sum(l_quantity) as double) s from lineitem group by 1,2,3) select engine, model, accel, s as seconds, round(s/max(s) over (partition by engine, model),6) ratio from s")
def engine_cost_by_accel(spark, d):
    t = T.table(spark, d, "lineitem").select(F.col("l_returnflag").alias("engine"), F.col("l_linestatus").alias("model"), F.col("l_linenumber").cast("string").alias("accel"), F.col("l_quantity").cast("double").alias("seconds"))
    return reports.total_cost(t, ["engine", "model", "accel"], ["engine", "model"]).withColumn("ratio", F.round("ratio", 6))


@query(f"with {DET} select distinct video from det where video%4=0")
def videos_without_detections(spark, d):
    """Videos with frames that a detector found nothing in: here every fourth."""
    det = T.detections(spark, d)
    return signals.undetected(det, det.where("video % 4 <> 0"))
