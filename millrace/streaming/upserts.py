"""Incremental loads as streams: files in, merged target out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.merging import upsert


def stream_upsert(spark: SparkSession, source: str, schema: str, target: str, keys: list[str], checkpoint: str, files_per_batch: int = 16) -> int:
    """Merge every new file of `source` into the versions below `target`; returns the last version's batch number.

    Version n+1 is the merge of version n and batch n, so a batch that is run again after a failure gives the
    same version: the load happens once in effect. The stream stops when no file is left.
    """

    def merge(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        path = f"{target}/v={number + 1}"
        old = session.read.schema(batch.schema).parquet(f"{target}/v={number}") if number else batch.limit(0)
        upsert(old, batch, keys).drop("_change").write.mode("overwrite").parquet(path)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    last = query.lastProgress
    return last["batchId"] + 1 if last else 0


def stream_daily(spark: SparkSession, source: str, schema: str, late: str = "1 day") -> DataFrame:
    """Operations per day and employee from a file stream; days close when the watermark has passed them."""
    events = spark.readStream.schema(schema).parquet(source).withWatermark("start_time", late)
    return events.groupBy(F.window("start_time", "1 day").alias("day"), "employee_id").agg(F.count("*").alias("operations"), F.sum("duration_seconds").alias("duration"))
