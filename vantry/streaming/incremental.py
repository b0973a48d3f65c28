"""Recording names that arrive as a stream, registered once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantry.operators import catalog

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def incremental_catalog(names: DataFrame, rooms: DataFrame, cases: DataFrame, path: str, checkpoint: str) -> None:
    """Parses and matches the names (a stream with column filename) that were not registered before, until the source has no more.

    Names seen are kept in the query's own state store, on disk and by hash of the name, so a batch costs what it brings and not what is
    registered already. A batch's rows go to the folder of its number, which replaces what an earlier try of the same batch left there.
    Null names are no names.
    """
    spark = names.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)

    def register(batch: DataFrame, number: int) -> None:
        rows = catalog.match(catalog.parse_names(batch), rooms, cases)
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    fresh = names.where(F.col("filename").isNotNull()).select("filename").dropDuplicates(["filename"])
    fresh.writeStream.foreachBatch(register).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """filename, status, case_id, room, candidates of all batches; empty where none was written."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    kind = "filename string, status string, case_id string, room string, candidates string"
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).parquet(path).drop("batch")
