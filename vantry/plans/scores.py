"""Agreement of labellings, tags for identifiers, confidence of error rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from vantry.functions import edits
from vantry.operators import agreement
from vantry.plans.encounters import WORDS, query
from vantry.sources import tables as T


@query()
def der(spark, d):
    gold = T.turns(spark, d).select("case_id", "start_s", "end_s", "speaker")
    late = F.when(F.col("start_s") % 3 < 1, 0.5).otherwise(0.0)
    found = gold.where("cast(start_s as int) % 700 <> 0").withColumn("start_s", F.col("start_s") + late).withColumn("speaker", F.concat(F.lit("S"), F.length("speaker") % 4))
    out = agreement.der(found, gold)
    return out.select("case_id", *(F.round(c, 6).alias(c) for c in out.columns[1:]))


@query(f"""with {WORDS}, n as (select case_id, count(*) filter (lower(regexp_replace(word,'[^a-zA-Z0-9]','','g'))<>'') n, count(*) filter (lower(regexp_replace(word,'[^a-zA-Z0-9]','','g'))<>'' and (pos+turn)%7=3) gone from w group by 1)
 select case_id, 'a' "first", 'b' "second", case when n>0 then round(gone/n::double,4) end wer from n where gone<n""")
def annotator_agreement(spark, d):
    w = T.words(spark, d).withColumn("word", F.regexp_replace("word", "[^a-zA-Z0-9]", "")).where("word <> ''")
    text = lambda rows: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "pos", "word"))), lambda x: x["word"]), " ").alias("text")
    one = w.groupBy("case_id").agg(text(w)).withColumn("annotator", F.lit("a"))
    other = w.where("(pos + turn) % 7 <> 3").groupBy("case_id").agg(text(w)).withColumn("annotator", F.lit("b"))
    return agreement.annotator_agreement(one.unionByName(other))


@query(rf"""with {WORDS}, b as (select *, case when turn%5=1 and pos=2 then '01/02/1990,' when turn%5=2 and pos=2 then '1234567' else word end said from w),
 k as (select distinct case_id, lower(regexp_replace(word,'^[[:punct:]]+|[[:punct:]]+$','','g')) name from w where turn=0 and pos<2 and regexp_matches(word,'^[\x00-\x7F]*$')),
 x as (select *, lower(regexp_replace(said,'^[[:punct:]]+|[[:punct:]]+$','','g')) bare from b where regexp_matches(said,'^[\x00-\x7F]*$'))
 select x.case_id, turn, pos, case when name is not null then '[PATIENT_NAME]' when regexp_full_match(bare,'[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2,4}}') then '[DOB]' when regexp_full_match(bare,'[0-9]{{6,}}') then '[ID]' else said end word
 from x left join k on k.case_id=x.case_id and k.name=x.bare and k.name<>''""")
def phi_tagging(spark, d):
    w = T.words(spark, d)
    plain = F.col("word").rlike(r"^[\x00-\x7F]*$")
    names = w.where("turn = 0 and pos < 2").where(plain).select("case_id", F.col("word").alias("name"), F.lit("[PATIENT_NAME]").alias("tag"))
    said = F.when(F.expr("turn % 5 = 1 and pos = 2"), "01/02/1990,").when(F.expr("turn % 5 = 2 and pos = 2"), "1234567").otherwise(F.col("word"))
    return agreement.phi_tagged(w.select("case_id", "turn", "pos", said.alias("word")).where(plain), names)


_WEIGHT = "+".join(f"(case when c>{p} then 1 else 0 end)" for p in agreement.POISSON)


@query(f"""with i as (select o_orderstatus engine, o_orderkey, o_orderkey%7 errors, 20+o_orderkey%13 words from orders),
 d as (select *, ('0x'||substr(md5(o_orderkey||':'||draw),1,8))::bigint/4294967296.0 c from i, (select unnest(range(1,101)) draw)),
 s as (select engine, draw, sum(errors*({_WEIGHT}))/sum(words*({_WEIGHT}))::double r from d group by 1,2)
 select engine, round(any_value(rate),6) rate, round(quantile_cont(r,0.025),6) low, round(quantile_cont(r,0.975),6) high from s join (select engine, sum(errors)/sum(words)::double rate from i group by 1) using (engine) group by 1""")
def error_confidence(spark, d):
    items = T.table(spark, d, "orders").select(F.col("o_orderstatus").alias("engine"), "o_orderkey", (F.col("o_orderkey") % 7).alias("errors"), (20 + F.col("o_orderkey") % 13).alias("words"))
    out = agreement.error_confidence(items, "engine", "o_orderkey", "errors", "words")
    return out.select("engine", *(F.round(c, 6).alias(c) for c in ("rate", "low", "high")))


@query(f"""with {WORDS}, t as (select lower(word) ref_word, (pos+turn)%7=3 heard from w where word<>'') select ref_word, ref_word||'~' hyp_word, count(*) filter (heard) n, round(count(*) filter (heard)/count(*)::double,6) share from t group by 1 having count(*) filter (heard)>0""")
def substitution_pairs(spark, d):
    """Words that an engine mishears: every turn as reference, and again with some words replaced."""
    w = T.words(spark, d).where("word <> ''").withColumn("word", F.lower("word"))
    heard = F.when((F.col("pos") + F.col("turn")) % 7 == 3, F.concat("word", F.lit("~"))).otherwise(F.col("word")).alias("heard")
    turns = w.groupBy(F.concat("case_id", F.lit("/"), "turn").alias("id")).agg(F.array_sort(F.collect_list(F.struct("pos", "word", heard))).alias("ws"))
    text = lambda k: F.array_join(F.transform("ws", lambda x: x[k]), " ")
    return edits.substitution_pairs(turns.select("id", text("word").alias("ref"), text("heard").alias("hyp"))).withColumn("share", F.round("share", 6))
