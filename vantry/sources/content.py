"""SHA-256 of files: small ones by one scan, large ones in chunks. Files stand by themselves or, where they are many, in bundles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LARGEST = 64 << 20  # bytes of a file that is read into a row
CHUNK = 4 << 20
PART = 16 << 10  # bytes of a row of a bundle, at most


def chunked_sha256(path: str, chunk: int = CHUNK) -> str:
    """Of a file in any file system that pyarrow opens by its URI (local, s3, gs, hdfs), `chunk` bytes at a time."""
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path)
    running = hashlib.sha256()
    with system.open_input_stream(place) as f:
        while block := f.read(chunk):
            running.update(block)
    return running.hexdigest()


def fingerprints(spark: SparkSession, path: str, largest: int = LARGEST) -> DataFrame:
    """path, length, sha256 of all files below a path that hold anything: Spark's file sources don't list empty files.

    Files of at most `largest` bytes come with their content from the binaryFile source, where the hash is a column expression. That source can't
    hold a large file in a row; such files come without content, are dealt to tasks by path, and each is hashed chunk by chunk.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    small = files.where(F.col("length") <= largest).select("path", "length", F.sha2("content", 256).alias("sha256"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [chunked_sha256(p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hashes, pa.string())], names=["path", "length", "sha256"])

    large = files.where(F.col("length") > largest).select("path", "length")  # the filter on length reaches the scan and content is not read
    spread = large.repartition(F.xxhash64("path"))
    return small.unionByName(spread.mapInArrow(run, "path string, length long, sha256 string"))


def write_bundle(files: DataFrame, path: str, most: int = PART) -> None:
    """Files (path, content) as one table, a row for each `most` bytes: neither an entry of a folder for each file nor a row for a large one. Null content is no file."""
    held = files.where("content is not null").select("path", F.col("content").cast("binary").alias("content"))
    size = F.octet_length("content").cast("long")
    counted = held.select("path", size.alias("length"), F.greatest(F.ceil(size / most), F.lit(1)).cast("int").alias("parts"), "content")
    rows = counted.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    rows.select("path", "length", "parts", "part", F.expr(f"substring(content, part * {most} + 1, {most})").alias("content")).write.parquet(path)


def bundle_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """path, length, sha256 of the files of a bundle. A file of one row is hashed by a column expression; the rows of a longer one meet in one task
    in their order and are hashed one after the other, so it is never held whole. Two longer files of one path stop the job."""
    rows = spark.read.schema("path string, length long, parts int, part int, content binary").parquet(path)
    small = rows.where("parts = 1").select("path", "length", F.sha2("content", 256).alias("sha256"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running, due = hashlib.sha256(), 0
        for batch in batches:
            done = []
            for k, (parts, part, held) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("parts", "part", "content")), strict=True)):
                if part != due:
                    raise ValueError(f"part {part} of {batch.column('path')[k]} where {due} is due")
                running.update(held)
                due += 1
                if due == parts:
                    done.append((k, running.hexdigest()))
                    running, due = hashlib.sha256(), 0
            ended = batch.take(pa.array([k for k, _ in done], pa.int64()))
            yield pa.RecordBatch.from_arrays([ended.column("path"), ended.column("length"), pa.array([h for _, h in done], pa.string())], names=["path", "length", "sha256"])

    large = rows.where("parts > 1").repartition("path").sortWithinPartitions("path", "part")
    return small.unionByName(large.mapInArrow(run, "path string, length long, sha256 string"))
