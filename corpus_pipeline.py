"""From raw documents to training tokens: language, boilerplate, near copies, benchmark leaks, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes and rereads
as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantry.llm import bpe, decontam, jaccard_join, langid, line_dedup
from vantry.llm.scratch import hinted, written

SHORT = 100


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled rows teach; those without letters or near none of them go.

    A text of under SHORT characters with a letter says too little about its language and stays. Null and empty texts go. Repeated rows and null keys are judged like others.
    """
    model = langid.train(docs)
    short = F.char_length(F.col("row").getField("text")) < SHORT
    found = langid.predict(docs, model, keep=True).where((F.col("lang_pred") != langid.UNKNOWN) & (short | (F.col("score") >= model.least)))
    return found.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def line_dedup_by_site(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; n_chars follows the text. Null texts stay null."""
    return line_dedup.clean(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least doc_id. Documents without doc_id cannot be named and stay."""
    classes = jaccard_join.linked_classes(docs)
    copies = written(classes.where("component <> doc_id").select("doc_id").distinct(), "copies")
    return docs.join(hinted(copies, 8), "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, re-parameterised or not, with or without a doc_id. Null texts stay."""
    found = decontam.judged(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where("not contaminated").select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and decoded_sha256 of the bytes that the ids decode to. Null texts have no ids."""
    rows = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decoded=True)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup_by_site),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", token_ids),
]

#: Kernel scores and merges are beyond SQL; tests hold run() against plain code on a small fixture.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
