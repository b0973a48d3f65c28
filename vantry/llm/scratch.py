"""Tables that cut lineage, written to the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantry.sources.files import new_path

BROADCAST_BYTES = 32 << 20  # what is larger is not broadcast


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Lowers the session's rows an Arrow batch: whole texts are long, and each task holds several batches in the executor and in its worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of df, read back from a Parquet table in the shared folder."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def dropped(*tables: DataFrame | None) -> None:
    """Deletes written tables that nothing reads any more."""
    for table in tables:
        if path := getattr(table, "scratch_path", None):
            spark = table.sparkSession
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def size_bytes(table: DataFrame, widths: int = 0, *columns: str) -> int:
    """Bytes of a written table's rows: `widths` for each row and what the named string, binary or array columns hold (8 bytes an element)."""
    held = [F.coalesce(F.octet_length(c) if table.schema[c].dataType.typeName() in ("string", "binary") else 8 * F.size(c), F.lit(0)) for c in columns]
    total = F.lit(widths)
    for x in held:
        total = total + x
    return table.agg(F.sum(total.cast("long"))).first()[0] or 0


def hinted(table: DataFrame, widths: int, *columns: str, most: int = BROADCAST_BYTES) -> DataFrame:
    """A written table, to be broadcast while its rows have at most `most` bytes (see size_bytes)."""
    return F.broadcast(table) if size_bytes(table, widths, *columns) <= most else table
