"""Chunks staged side by side and moved into the target one at a time.

Staging and target are folders with a partition per chunk. Staging a chunk again replaces its partition; moving a chunk
writes its partition of the target from the staged rows and the keys of all *other* chunks, never from what an earlier
attempt left behind. So either step may be repeated after a failure and gives the same rows.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = "_chunk_id"


class Moved(NamedTuple):
    chunk: int
    rows_read: int
    rows_inserted: int
    rows_conflicted: int


def _path(root: str, chunk: int) -> str:
    return f"{root}/{CHUNK}={chunk}"


def chunks_of(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of a staging or target folder with their chunk, in the columns of schema; empty if there is no folder yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    kept = spark.createDataFrame([], schema).withColumn(CHUNK, F.lit(0).cast("long"))
    return spark.read.schema(kept.schema).option("basePath", path).parquet(path) if there else kept


def stage(batch: DataFrame, path: str, chunk: int | Column) -> None:
    """Write a batch as one chunk, or as those that a column of whole numbers names, in place of what was staged for them.

    An empty batch of one chunk empties that chunk. With a column, chunks without rows stay as they are, and rows whose
    chunk is null raise an error.
    """
    if isinstance(chunk, Column):
        missing = F.raise_error(F.lit("a row without a chunk can't be staged")).cast("long")
        rows = batch.withColumn(CHUNK, F.coalesce(chunk.cast("long"), missing))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(CHUNK).parquet(path)
    else:
        batch.write.mode("overwrite").parquet(_path(path, chunk))


def finalize_chunk(spark: SparkSession, staging: str, target: str, schema, keys: list[str], chunk: int) -> Moved:
    """Move one staged chunk: rows whose key another chunk of the target holds conflict and stay out, the rest is inserted.

    Of staged rows with one key the least by all columns counts, the others conflict. Null keys conflict with nothing. Of
    the target only the keys are read, and of them only the range between the chunk's least and greatest first key. The
    staged rows are pre-aggregated before they are shuffled, so a key that fills a chunk is one row per task by then.
    Columns must be orderable (no maps). Conflicts are rows read less rows inserted, counted from what was written.
    """
    staged = chunks_of(spark, staging, schema).where(F.col(CHUNK) == chunk).drop(CHUNK)
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    facts = staged.agg(F.count(F.lit(1)), F.min(keys[0]), F.max(keys[0])).first()
    others = [c for c in staged.columns if c not in keys]
    first = staged.where(known).groupBy(*keys).agg(F.min(F.struct(*others) if others else F.lit(1)).alias("_row"))
    unique = first.select(*[F.col(f"_row.{c}").alias(c) if c in others else F.col(c) for c in staged.columns])
    taken = chunks_of(spark, target, schema).where(F.col(CHUNK) != chunk).select(*keys)
    if facts[1] is not None:
        kind = staged.schema[keys[0]].dataType
        taken = taken.where(F.col(keys[0]).between(F.lit(facts[1]).cast(kind), F.lit(facts[2]).cast(kind)))
    moved = unique.join(taken, keys, "left_anti").select(*staged.columns).unionByName(staged.where(~known))
    moved.write.mode("overwrite").parquet(_path(target, chunk))  # of other chunks' folders nothing changes
    inserted = spark.read.schema(staged.schema).parquet(_path(target, chunk)).count()
    return Moved(chunk, facts[0], inserted, facts[0] - inserted)


def chunk_counts(staged: DataFrame, moved: DataFrame) -> DataFrame:
    """Per staged chunk: rows read, inserted and conflicted, from the two folders' rows."""
    a = staged.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("rows_read"))
    b = moved.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("rows_inserted"))
    n = F.coalesce("rows_inserted", F.lit(0))
    return a.join(b, CHUNK, "left").select(F.col(CHUNK).alias("chunk_id"), "rows_read", n.alias("rows_inserted"), (F.col("rows_read") - n).alias("rows_conflicted"))
