"""Queries over encounters, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from vantry.functions import scalars as S
from vantry.operators import catalog, manifest, reports, signals
from vantry.sources import tables as T

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


REC = "rec as (select strftime(ts,'%Y%m%d-%H%M%S')||'-v'||event_id||'-'||user_id||'.mp4' filename, ts, event_id, user_id from events)"
ROOMS = "rooms as (select distinct cast(user_id as varchar) camera_id, lpad(cast(user_id%30 as varchar),2,'0') room_number from events where user_id%11<>0)"
CASES = "cs as (select p||event_id case_id, cast(user_id%30 as varchar) room_number, lower(strftime(ts,'%m/%d/%Y %I:%M %p')) recording_start, date_trunc('minute',ts) m from events, (values ('C'),('D')) v(p) where (p='C' and event_id%3<>0) or (p='D' and event_id%15=1))"
VIDEOS = """v as (select cast(o_custkey as varchar) case_id, (case when o_orderkey%13=0 then 'x' else '' end)||o_orderkey camera,
 case when o_orderkey%17=0 then null else round(o_totalprice/100,4) end duration_s, case o_orderstatus when 'P' then 'pending' when 'F' then 'done' else 'failed' end pose_status,
 case o_orderkey%3 when 0 then 'pending' when 1 then 'done' else 'failed' end asr_status,
 ['pending','done','failed','skipped'][o_orderkey%5%4+1] audio_status, ['pending','done','failed','skipped'][o_orderkey%7%4+1] diarize_status, ['pending','done','failed','skipped'][o_orderkey%11%4+1] elan_status from orders)"""
STAGES = ("audio", "asr", "diarize", "elan", "pose")
WORDS = r"""w as (select case_id, turn, pos, ws[pos+1] word, cast(turn*100+pos*0.25 as double) start_s, cast(turn*100+pos*0.25+(pos%3)*0.1 as double) end_s, speaker from
 (select cast(conv_id as varchar) case_id, turn, role speaker, ws, unnest(range(len(ws))) pos from (select *, regexp_split_to_array(trim(text),'\s+') ws from conversations)))"""
TURNS = """t as (select cast(conv_id as varchar) case_id, turn*100+0.1 s, turn*100+5+turn*3 e, role who from conversations union all
 select cast(conv_id as varchar), turn*100+4, turn*100+20, 'other' from conversations where turn%2=0)"""
PITCH = "p as (select user_id case_id, event_id, epoch(ts)-epoch(timestamp '2024-01-01') t, case when event_type='error' then 0 else 110+value end hz, value from events), pt as (select user_id case_id, 'S'||event_id%3 speaker, epoch(ts)-epoch(timestamp '2024-01-01') s, epoch(ts)-epoch(timestamp '2024-01-01')+86400 e from events where event_type='signup')"
POSE = "pose as (select label video, row_number() over (partition by label order by vec_id)-1 frame, [[12*embedding[2*j+1]::double,12*embedding[2*j+2]::double] for j in range(32)] pts from embeddings)"
MATCH = f"""with {REC}, {ROOMS}, {CASES}, r as (select rec.filename, rooms.room_number is null no_room, cast(cast(rooms.room_number as int) as varchar) room, count(cs.case_id) n, coalesce(string_agg(cs.case_id, ',' order by cs.case_id),'') ids
 from rec left join rooms on rooms.camera_id=cast(rec.user_id as varchar) left join cs on cast(cast(rooms.room_number as int) as varchar)=cs.room_number and date_trunc('minute',rec.ts)=cs.m group by 1,2,3),
 m as (select filename, case when no_room then 'no_room' when n=0 then 'no_match' when n=1 then 'matched' else 'ambiguous' end status, case when n=1 and not no_room then ids end case_id, case when n=1 and not no_room then room else '' end room, case when n>1 then ids else '' end candidates from r)"""


@query(f"with {REC} select filename, true ok, strftime(ts,'%Y-%m-%d') video_date, strftime(ts,'%H:%M:%S') video_time, 'v'||event_id recording_id, cast(user_id as varchar) camera from rec")
def recording_name_parse(spark, d):
    return catalog.parse_names(T.recordings(spark, d))


@query("select page_id, sha256(html) sha256 from pages")
def content_fingerprint(spark, d):
    return T.table(spark, d, "pages").select("page_id", F.sha2(F.col("html").cast("binary"), 256).alias("sha256"))


@query("select p_partkey path, p_retailprice duration_s, case when p_partkey%3=0 then null else p_size/(p_partkey%3)::double end fps, p_size*10 width, p_size*5 height, p_partkey%2=0 has_audio from part")
def media_facts(spark, d):
    return catalog.media_facts(T.probe_json(spark, d)).withColumn("path", F.col("path").cast("long"))


@query("select cast(c_custkey as varchar) case_id, c_mktsegment event_name, '' case_name, '' group_name, cast(c_nationkey as varchar) room_number, c_name learner_name, '' sp_name, '' recording_start_time from customer")
def case_sheet_import(spark, d):
    return catalog.sheets_to_cases(T.sheet_cells(spark, d))


@query("select distinct cast(user_id as varchar) camera_id, cast(user_id%30 as varchar) room from events where user_id%11<>0")
def camera_room_import(spark, d):
    rooms = T.camera_rooms(spark, d).select("camera_id", F.concat(F.lit("'"), "room_number", F.lit("' ")).alias("room_number"))
    return rooms.select(S.normalize_identifier(F.col("camera_id")).alias("camera_id"), S.normalize_identifier(F.col("room_number")).alias("room"))


@query(f"with {CASES} select case_id, strftime(m,'%Y-%m-%dT%H:%M:%S') start from cs")
def recording_start_parse(spark, d):
    return T.cases(spark, d).select("case_id", S.recording_start(F.col("recording_start")).alias("start"))


@query(MATCH + " select * from m")
def case_match(spark, d):
    return catalog.match(catalog.parse_names(T.recordings(spark, d)), T.camera_rooms(spark, d), T.cases(spark, d))


@query(MATCH + " select filename, status, candidates from m where status<>'matched'")
def unresolved_matches(spark, d):
    return case_match(spark, d).where("status <> 'matched'").select("filename", "status", "candidates")


@query(MATCH + " select status, count(*) n from m group by 1")
def match_outcome_tally(spark, d):
    return case_match(spark, d).groupBy("status").agg(F.count("*").alias("n"))


@query(MATCH + " select filename from m where status<>'matched'")
def match_cache_reuse(spark, d):
    """Files whose cached match is not final and that are matched again."""
    cached = case_match(spark, d).where("status = 'matched'")
    return T.recordings(spark, d).join(cached, "filename", "left_anti")


@query(f"with {VIDEOS} select case_id, camera, duration_s, c_name case_name from v join customer on c_custkey=cast(case_id as bigint) where pose_status='pending'")
def pending_with_case(spark, d):
    cases = T.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("case_id"), F.col("c_name").alias("case_name"))
    return manifest.pending(T.videos(spark, d), cases, "pose").select("case_id", "camera", "duration_s", "case_name")


@query(f"with {VIDEOS} select case_id, camera from (select *, row_number() over (partition by case_id order by case when regexp_full_match(camera,'-?[0-9]+') then 0 else 1 end, try_cast(camera as bigint), camera) n from v) where n=1")
def audio_camera_election(spark, d):
    return manifest.elect_camera(T.videos(spark, d))


@query(f"""with {VIDEOS}, e as (select case_id, camera c from (select *, row_number() over (partition by case_id order by case when regexp_full_match(camera,'-?[0-9]+') then 0 else 1 end, try_cast(camera as bigint), camera) n from v) where n=1)
 select case_id, camera, case when asr_status='pending' and camera<>c then 'skipped' else asr_status end asr_status, pose_status from v join e using(case_id)""")
def skip_non_audio_camera(spark, d):
    v = T.videos(spark, d)
    return manifest.skip_others(v, manifest.elect_camera(v), "asr").select("case_id", "camera", "asr_status", "pose_status")


@query(f"with {VIDEOS} select case_id, camera, row_number() over (order by coalesce(duration_s,0), case_id, camera)-1 as rank, (row_number() over (order by coalesce(duration_s,0), case_id, camera)-1)%4 as shard from v where pose_status='pending'")
def shard_assign(spark, d):
    return manifest.interleaved_rank(T.videos(spark, d).where("pose_status = 'pending'"), 4).select("case_id", "camera", "rank", "shard")


@query(f"with {VIDEOS} " + " union all ".join(f"select '{x}' stage, {x}_status status, count(*) n from v group by 2" for x in STAGES))
def status_tally(spark, d):
    return reports.status_tally(T.videos(spark, d), {s: f"{s}_status" for s in STAGES})


@query(f"with {VIDEOS} " + " union all ".join(f"select '{x}' stage, {x}_status in ('done','skipped') ok, count(*) n from v where {x}_status<>'pending' group by 2" for x in STAGES))
def outcome_tally(spark, d):
    return reports.outcome_tally(T.videos(spark, d), {s: f"{s}_status" for s in STAGES})


@query("select cast(user_id as varchar) case_id, max_by(event_type, struct_pack(a:=ts,b:=event_id)) status from events group by 1")
def current_state(spark, d):
    log = T.table(spark, d, "events").select(F.col("user_id").cast("string").alias("case_id"), F.lit("1").alias("camera"), F.lit("pose").alias("stage"), F.col("event_type").alias("status"), F.col("ts").alias("at"), F.col("event_id").alias("attempt"))
    return manifest.current_state(log).select("case_id", "status")


@query("select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) n from events) where n=1")
def latest_per_key(spark, d):
    return catalog.latest(T.table(spark, d, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type")


@query("select cast(c_custkey as varchar) case_id from customer where c_custkey not in (select o_custkey from orders where o_orderstatus='P')")
def new_keys(spark, d):
    """Cases of the sheets that no video waits for."""
    known = T.videos(spark, d).where("pose_status = 'pending'").select("case_id").distinct()
    return catalog.absent(T.sheet_cells(spark, d).select(F.col("sheet").alias("case_id")).distinct(), known, ["case_id"])


@query(f"with {VIDEOS} select case_id, camera from v where cast(case_id as bigint) not in (select c_custkey from customer where c_custkey%7<>0)")
def fk_violations(spark, d):
    known = T.table(spark, d, "customer").where("c_custkey % 7 <> 0").select(F.col("c_custkey").cast("string").alias("case_id"))
    return catalog.absent(T.videos(spark, d), known, ["case_id"]).select("case_id", "camera")


@query(f"with {VIDEOS} select case_id, count(*) n from v group by 1 having count(*)>1")
def duplicate_keys(spark, d):
    return catalog.repeated(T.videos(spark, d), ["case_id"])


@query("select doc_id, s sha256, n from (select doc_id, sha256(text) s, count(*) over (partition by text) n from documents where text is not null) where n>1")
def duplicate_content(spark, d):
    """Every document whose text stands under several keys, with the number of them."""
    rows = T.table(spark, d, "documents").where("text is not null").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
    return rows.join(catalog.repeated(rows, ["sha256"]), "sha256").select("doc_id", "sha256", "n")


@query(f"with {VIDEOS} select case_id from v where asr_status='done' intersect select case_id from v where pose_status='done'")
def ready_cases(spark, d):
    v = T.videos(spark, d)
    return v.where("asr_status = 'done'").select("case_id").intersect(v.where("pose_status = 'done'").select("case_id"))


@query(f"with {VIDEOS} select a.case_id, a.camera, exists(select 1 from v b where b.case_id=a.case_id and b.asr_status='done') ready from v a where a.asr_status='pending'")
def stage_prerequisite(spark, d):
    v = T.videos(spark, d)
    return reports.prerequisite(v.where("asr_status = 'pending'").select("case_id", "camera"), v.where("asr_status = 'done'"), ["case_id"])


@query(f"with {VIDEOS} select case_id, round(max(duration_s)-min(duration_s),4) spread from v group by 1 having max(duration_s)-min(duration_s)>100")
def camera_sync_check(spark, d):
    return reports.camera_spread(T.videos(spark, d), 100).withColumn("spread", F.round("spread", 4))


@query(f"""with {VIDEOS} select case_id, camera, case when asr_status='done' or pose_status='done' then 'done' when asr_status='failed' or pose_status='failed' then 'failed' else 'pending' end status, asr_status<>pose_status conflict from v""")
def merge_forked_manifests(spark, d):
    v = T.videos(spark, d)
    return manifest.merge_forks(v.withColumn("status", F.col("asr_status")), v.withColumn("status", F.col("pose_status")), "status")


@query(f"""with {WORDS}, {TURNS}, o as (select w.case_id, turn, pos, who, round(sum(least(end_s,e)-greatest(start_s,s)),6) x from w join t on w.case_id=t.case_id and start_s<e and s<end_s group by 1,2,3,4)
 select w.case_id, w.turn, w.pos, who speaker from w left join (select *, row_number() over (partition by case_id,turn,pos order by x desc, who) n from o) b on b.case_id=w.case_id and b.turn=w.turn and b.pos=w.pos and n=1""")
def word_speaker_assign(spark, d):
    return signals.assign_speakers(T.words(spark, d), T.turns(spark, d))


@query(f"""with {WORDS}, a as (select *, case when lag(speaker) over o is distinct from speaker then 1 else 0 end n from w window o as (partition by case_id order by turn,pos)),
 b as (select *, cast(sum(n) over (partition by case_id order by turn,pos rows unbounded preceding) as bigint) island from a)
 select case_id, island, speaker, min_by(start_s,struct_pack(a:=turn,b:=pos)) start_s, '['||strftime(make_timestamp(cast(floor(min_by(start_s,struct_pack(a:=turn,b:=pos)))*1000000 as bigint)),'%H:%M:%S')||'] '||speaker||': '||string_agg(word,' ' order by turn,pos) filter (trim(word)<>'') line from b group by 1,2,3""")
def speaker_turns(spark, d):
    return signals.speaker_turns(T.words(spark, d))


@query(f"with {WORDS} select case_id, speaker tier, cast(round_even(start_s*1000,0) as bigint) start_ms, cast(round_even(end_s*1000,0) as bigint) end_ms, trim(word) as value from w where trim(word) not in ('','.',',','?','!') and cast(round_even(end_s*1000,0) as bigint)>cast(round_even(start_s*1000,0) as bigint)")
def annotation_ms(spark, d):
    return signals.annotations(T.words(spark, d))


TIERS = f"""with {WORDS}, s as (select case_id, case when regexp_full_match(speaker,'[0-9]+') then 'SPEAKER_'||lpad(cast(cast(speaker as bigint) as varchar),2,'0') else coalesce(speaker,'Unknown_Speaker') end tier,
 round_even(start_s*1000,0) a, round_even(end_s*1000,0) b from w where trim(word) not in ('','.',',','?','!')),
 x as (select distinct case_id, tier from (select case_id from w), (values ('LEARNER'),('PATIENT'),('PRECEPTOR'),('ANNOUNCEMENT'),('OUTSIDE_ROOM')) v(tier) union select case_id, tier from s)"""


@query(TIERS + " select x.case_id, x.tier, count(s.case_id) n from x left join s on s.case_id=x.case_id and s.tier=x.tier and b>a group by 1,2")
def tier_word_counts(spark, d):
    return signals.tier_counts(T.words(spark, d))


@query(TIERS + " select * from x")
def tier_union(spark, d):
    return signals.tiers(T.words(spark, d))


@query(f"with {WORDS} select case_id, string_agg(trim(word),' ' order by turn,pos) filter (trim(word)<>'') hypothesis from w group by 1")
def hypothesis_text(spark, d):
    return reports.hypothesis_text(T.words(spark, d))


@query(f"with {PITCH} select p.case_id, speaker, round(median(hz),6) median_hz, count(*) n_frames, case when median(hz)<145 then 'lower' when median(hz)>185 then 'higher' else 'ambiguous' end bucket from p join pt on p.case_id=pt.case_id and t>=s and t<e where hz>0 group by 1,2 having count(*)>=10")
def speaker_register_summary(spark, d):
    return signals.speaker_pitch(T.pitch(spark, d), T.pitch_turns(spark, d)).withColumn("median_hz", F.round("median_hz", 6))


@query(f"with {PITCH}, r as (select p.case_id, speaker, median(hz) m from p join pt on p.case_id=pt.case_id and t>=s and t<e where hz>0 group by 1,2 having count(*)>=10) select case_id, case when m<145 then 'lower' when m>185 then 'higher' else 'ambiguous' end bucket, count(*) n from r group by 1,2")
def register_counts(spark, d):
    return reports.register_counts(signals.speaker_pitch(T.pitch(spark, d), T.pitch_turns(spark, d)))


@query(f"with {PITCH} select p.case_id, event_id, speaker, hz from p join pt on p.case_id=pt.case_id and t>=s and t<e where hz>0")
def pitch_in_turn(spark, d):
    return signals.pitch_in_turns(T.pitch(spark, d), T.pitch_turns(spark, d)).select("case_id", "event_id", "speaker", "hz")


@query(f"""with {PITCH} select case_id, row_number() over (partition by case_id order by t,event_id) frame, greatest(0,t-0.02) start_s, t+0.02 end_s, case when hz=0 then null else hz end pitch,
 case when event_id%6=0 then 'nan'::double else value::double end intensity, case when event_id%5=0 then null else value*2 end::double harmonicity,
 """ + ", ".join(f"case when event_id%{n}=0 then 'nan'::double when event_id%{n}=1 then null else {k}*100+value end::double formant_{k}" for k, n in enumerate((7, 8, 9, 10), 1)) + " from p")
def acoustic_frames(spark, d):
    nan, value, event = F.lit(float("nan")), F.col("intensity"), F.col("event_id")
    formants = {f"formant_{k}": F.when(event % n == 0, nan).when(event % n == 1, None).otherwise(k * 100 + value) for k, n in enumerate((7, 8, 9, 10), 1)}
    more = {"pitch": F.when(F.col("hz") == 0, nan).otherwise(F.col("hz")), "harmonicity": F.when(event % 5 == 0, nan).otherwise(value * 2), **formants, "intensity": F.when(event % 6 == 0, nan).otherwise(value)}
    return signals.acoustic_frames(T.pitch(spark, d).withColumns(more), 0.04, "event_id")


@query(f"with {POSE} select video, frame, round(degrees(atan2(pts[7][2]-pts[6][2],pts[7][1]-pts[6][1])),5) angle, round(pts[1][2]-(pts[6][2]+pts[7][2])/2,5) lean from pose")
def torso_angle(spark, d):
    angle, lean = signals.torso(F.col("points"))
    return T.pose(spark, d).select("video", "frame", F.round(angle, 5).alias("angle"), F.round(lean, 5).alias("lean"))


@query(f"with {POSE}, a as (select video, frame, degrees(atan2(pts[7][2]-pts[6][2],pts[7][1]-pts[6][1])) a from pose), b as (select video, frame, avg(a) over w m, count(*) over w n from a window w as (partition by video order by frame rows between current row and 4 following)) select video, frame, round(m,5) angle, abs(m)>20 away from b where n=5")
def facing_angle_series(spark, d):
    return signals.facing_series(T.pose(spark, d)).select("video", "frame", F.round("angle", 5).alias("angle"), reports.looking_away(F.col("angle")).alias("away"))


@query(f"with {POSE}, a as (select video, frame, pts, lead(pts) over (partition by video order by frame) q from pose), b as (select video, frame, 30*greatest(sqrt((q[10][1]-pts[10][1])**2+(q[10][2]-pts[10][2])**2),sqrt((q[11][1]-pts[11][1])**2+(q[11][2]-pts[11][2])**2)) v from a where q is not null) select video, frame, round(v,5) velocity, v>150 gesturing from b")
def wrist_velocity(spark, d):
    return signals.wrist_velocity(T.pose(spark, d)).select("video", "frame", F.round("velocity", 5).alias("velocity"), reports.gesturing(F.col("velocity")).alias("gesturing"))


@query(f"with {POSE} select video, avg(case when len(list_filter(flatten(pts), lambda x: x<>0))>0 then 1.0 else 0.0 end) presence from pose group by 1")
def slot_presence(spark, d):
    return reports.slot_presence(T.pose(spark, d), "video")


@query(f"with {POSE}, a as (select video, frame, [p for p in pts if p[1]/12>0.3] g from pose) select video, frame, 0 slot, len(g)>0 visible, 'P0' label, trunc(list_min([x[1] for x in g])) x, trunc(list_min([x[2] for x in g]))-8 y from a")
def slot_visibility(spark, d):
    return signals.visibility(T.pose(spark, d)).withColumns({c: F.col(c).cast("double") for c in ("x", "y")})


DET = "det as (select user_id%10 video, cast(floor((epoch(ts)-epoch(timestamp '2024-01-01'))/3600) as bigint) frame, value, row_number() over (partition by user_id%10, floor((epoch(ts)-epoch(timestamp '2024-01-01'))/3600) order by event_id)-1 i from events)"


@query(f"with {DET}, s as (select video, unnest(range(m+1)) frame from (select video, max(frame) m from det group by 1)) select s.video, s.frame, slot, coalesce(value,0) as value from s cross join (select unnest(range(4)) slot) left join det on det.video=s.video and det.frame=s.frame and i=slot")
def slot_pack(spark, d):
    det = T.detections(spark, d)
    frames = det.groupBy("video").agg(F.max("frame").alias("m")).select("video", F.explode(F.sequence(F.lit(0).cast("bigint"), "m")).alias("frame"))
    return signals.pack_slots(det, frames)


@query(f"with {DET}, s as (select video, unnest(range(m+1)) frame from (select video, max(frame) m from det group by 1)) select s.video, s.frame, i det_idx, value from s join det on det.video=s.video and det.frame=s.frame-s.frame%3 and det.frame%3=0")
def held_detections(spark, d):
    det = T.detections(spark, d)
    frames = det.groupBy("video").agg(F.max("frame").alias("m")).select("video", F.explode(F.sequence(F.lit(0).cast("bigint"), "m")).alias("frame"))
    return signals.held(frames, det, 3).select("video", "frame", "det_idx", "value")


@query("select l_returnflag engine, l_linestatus phase, round(sum(l_quantity),2) as seconds, round(100*sum(l_quantity)/sum(sum(l_quantity)) over (partition by l_returnflag),4) share from lineitem group by 1,2")
def stage_profile(spark, d):
    return reports.stage_profile(T.timing(spark, d)).withColumns({"seconds": F.round("seconds", 2), "share": F.round("share", 4)})


@query("select l_returnflag engine, l_linestatus phase, round(sum(l_quantity)/sum(l_extendedprice),6) factor from lineitem group by 1,2")
def realtime_factor(spark, d):
    return reports.realtime_factor(T.timing(spark, d), "engine", "phase").withColumn("factor", F.round("factor", 6))


@query("with e as (select l_returnflag engine, sum(l_quantity) s from lineitem group by 1) select a.engine, b.engine other, round(1-a.s/b.s,6) saved from e a join e b on a.engine<b.engine")
def engine_total_cost(spark, d):
    return reports.engine_savings(T.timing(spark, d)).withColumn("saved", F.round("saved", 6))


@query(r"select doc_id, trim(regexp_replace(regexp_replace(lower(b.text),'\p{P}','','g'),'\s+',' ','g')) ref, trim(regexp_replace(regexp_replace(lower(d.text),'\p{P}','','g'),'\s+',' ','g')) hyp from documents d join benchmark b on b.item_id=d.doc_id%(select max(item_id)+1 from benchmark)")
def text_normalize(spark, d):
    """Normalised whole texts of all languages and items."""
    return T.whole_text_pairs(spark, d).select("doc_id", S.normalized_text(F.col("ref")).alias("ref"), S.normalized_text(F.col("hyp")).alias("hyp"))


def _dealt(spark, d):
    """Pairs dealt anew: edits cost far more than moving the texts, and a scan gives one task a whole row group."""
    return text_normalize(spark, d).repartition(F.xxhash64("doc_id"))


@query()
def cer(spark, d):
    """Character error rates of whole texts, in code points; held against a plain edit distance in the tests."""
    return _dealt(spark, d).select("doc_id", S.char_error_rate(F.col("ref"), F.col("hyp")).alias("cer"))


@query()
def wer(spark, d):
    """Word error rates of whole texts; held against a plain edit distance in the tests."""
    return _dealt(spark, d).select("doc_id", S.word_error_rate(F.col("ref"), F.col("hyp")).alias("wer"))


@query()
def resumable_stage(spark, d):
    """Status rows of a stage that fails for some rows."""

    def work(row: dict) -> dict:
        if row["duration_s"] is None or row["duration_s"] != row["duration_s"]:
            raise ValueError("no duration")
        return {"status": "skipped"} if row["duration_s"] < 100 else {"asr_model": "engine/model"}

    return manifest.run_stage(T.videos(spark, d).where("pose_status = 'pending'").select("case_id", "camera", "duration_s"), work)
