"""The registered queries of this subpackage, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vantry.llm import attention_lm, bpe, collocations, decontam, jaccard_join, langid, line_dedup, order_minhash, prefix_trie, secrets, sharding, suffix_dedup, token_files
from vantry.llm.scratch import new_path

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(documents(spark, sf_dir), vocabulary, public_tokenizers.PATTERN, packed=True, decoded=True).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.judged(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "contaminated", "item_id", "n_items", "share")


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.train(docs.where(~held_out()))
    return langid.predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op4_simple8b_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    token_files.write(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read(spark, path).select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked_classes(documents(spark, sf_dir)).withColumnRenamed("component", "component_id")


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = order_minhash.edited_pairs(documents(spark, sf_dir))
    n = F.char_length("text")
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 2) as int))"), "tail")
    whole = pairs.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "signature", "next_signature")
    signed = whole.withColumn("edited_signature", order_minhash.signature(F.col("edited")))
    return signed.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        order_minhash.fingerprint(F.col("signature")).alias("fingerprint"),
        order_minhash.fingerprint(F.col("edited_signature")).alias("edited_fingerprint"),
        order_minhash.likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        order_minhash.likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )


def op7_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return sharding.assign(rows, 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_guess", "bits"
    )


def op9_site_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.clean(documents(spark, sf_dir), counts=True).select("doc_id", "text", "n_lines", "n_dropped")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.keep_unrepeated(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.scored(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


OP9_SQL = """
with host as (select source, count(*) n from documents group by source),
page_line as (select distinct doc_id, source, unnest(string_split(text, chr(10))) line from documents),
line as (select source, line, count(*) c from page_line where trim(line) <> '' group by source, line),
bad as (select l.source, list(l.line) b from line l join host h using (source) where c >= 5 and c * 10 > n group by l.source),
kept as (select doc_id, text, string_split(text, chr(10)) ls,
         list_filter(string_split(text, chr(10)), lambda x: not coalesce(list_contains(b, x), false)) ks
         from documents left join bad using (source))
select doc_id, array_to_string(ks, chr(10)) as text, coalesce(len(ls), 0) as n_lines, coalesce(len(ls) - len(ks), 0) as n_dropped from kept
"""


OP11_SQL = r"""
with pieces as (select coalesce(lang, 'und') lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece from documents),
lists as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') ws from pieces),
spots as (select lang, unnest(ws) w1, unnest(ws[2:]) w2, unnest(ws[3:]) w3 from lists),
f1 as (select lang, w1, count(*) n from spots group by all),
f2 as (select lang, w1, w2, count(*) n from spots where w2 is not null group by all),
f3 as (select lang, w1, w2, w3, count(*) n from spots where w3 is not null group by all having count(*) >= 10),
total as (select lang, sum(n) n from f1 group by lang),
longer as (select lang, w1, w2, max(n) m from (select lang, w1, w2, n from f3 union all select lang, w2, w3, n from f3) group by all),
cuts as (select f2.lang, f2.w1 || ' ' || f2.w2 phrase, f2.n a, 1 k, x.n l, y.n r from f2 join f1 x on x.lang = f2.lang and x.w1 = f2.w1 join f1 y on y.lang = f2.lang and y.w1 = f2.w2
  left join longer g on g.lang = f2.lang and g.w1 = f2.w1 and g.w2 = f2.w2 where f2.n >= 10 and 100 * coalesce(g.m, 0) < 50 * f2.n
  union all select f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.n, 1, x.n, y.n from f3 join f1 x on x.lang = f3.lang and x.w1 = f3.w1 join f2 y on y.lang = f3.lang and y.w1 = f3.w2 and y.w2 = f3.w3
  union all select f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.n, 2, x.n, y.n from f3 join f2 x on x.lang = f3.lang and x.w1 = f3.w1 and x.w2 = f3.w2 join f1 y on y.lang = f3.lang and y.w1 = f3.w3),
scored as (select *, cast(cast(a as hugeint) * a * 1000000 // (cast(l as hugeint) * r) as bigint) score from cuts),
lowest as (select * from (select *, row_number() over (partition by lang, phrase order by score, k) c from scored) where c = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) rank from lowest)
select lang, rank, phrase, a, l, r, cast(total.n as bigint) n, score from ranked join total using (lang) where rank <= 2000
"""


OP12_SQL = """
with t as (select conv_id, coalesce(role, '') "role", coalesce(text, '') "text", row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) pos from conversations where conv_id is not null),
whole as (select conv_id, list(struct_pack(r := "role", t := "text") order by pos) ts from t group by conv_id),
crc as (select conv_id, ts, conv_id - conv_id % 100 base, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(cast(conv_id as varchar), ''), lambda x: cast(ascii(x) as bigint))),
  lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)), 4294967295) % 6 h from whole),
made as (select c.conv_id, coalesce(b.ts[1:c.h], []) || c.ts[c.h + 1:] ts from crc c left join whole b on b.conv_id = c.base),
steps as (select conv_id, ts, unnest(range(len(ts) + 1)) d from made),
node as (select ts[1:d] p, d, min(conv_id) conv_id, count(*) n_convs, sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (len(ts) = d), '')) ends from steps group by all),
kids as (select p[1:d - 1] p, count(*) n from node where d > 0 group by 1),
fact as (select node.*, coalesce(kids.n, 0) n_children, case when node.d > 0 then (n_convs - 1) * length(node.p[node.d].t) else 0 end saved from node left join kids on kids.p = node.p),
roll as (select a.p, count(*) filter (b.n_children = 0) n_leaves, sum(b.saved) saved from fact a join fact b on b.d >= a.d and b.p[1:a.d] = a.p group by a.p)
select fact.conv_id, fact.d depth, up.conv_id parent_conv_id, fact.n_convs, fact.n_children, roll.n_leaves, cast(roll.saved as bigint) saved_tokens, fact.ends ends_sha256
from fact join roll on roll.p = fact.p left join fact up on fact.d > 0 and up.p = fact.p[1:fact.d - 1]
"""


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in (op1_byte_bpe, op2_template_decontamination, op3_language_id, op4_simple8b_files, op5_ngram_jaccard_join, op6_order_minhash, op7_hypergeometric_shards, op8_secret_scan, op9_site_line_dedup, op10_suffix_dedup, op11_phrase_collocations, op12_prefix_trie, op13_attention_lm)}


def oracle_sql() -> dict[str, str]:
    return {"op9_site_line_dedup": OP9_SQL, "op11_phrase_collocations": OP11_SQL, "op12_prefix_trie": OP12_SQL}
