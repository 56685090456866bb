"""Helpers that several corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Only a session on one machine may go without: it gets a folder of its own. On a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        found = spark.sparkContext.getCheckpointDir()
    if found is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-shared-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Have Spark hand texts to Python in batches of 4 MB rather than 64: a worker holds several copies of one.

    A session that has set the size itself keeps it.
    """
    if spark.conf.get(BATCH_BYTES).lower() in ("67108864b", "67108864", "64m", "64mb"):  # Spark's own value
        spark.conf.set(BATCH_BYTES, "4m")


def give_back() -> None:
    """At the end of a task: return freed memory to the system, since workers live on and share the executor's."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def scratch(spark: SparkSession, name: str) -> str:
    """A path for a new table in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df as Parquet into the shared folder and read it again.

    A lost executor then costs one task, not the chain of shuffles before it.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete the files behind tables made by written() that nothing reads any more, and let Spark clear the shuffle
    files of ended jobs: it does so when the driver's collector finds them unused, in long jobs too late for the disks."""
    for df in tables:
        spark = df.sparkSession
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(parent)
            path.getFileSystem(conf).delete(path, True)
    if len(tables) > 1:
        tables[0].sparkSession._jvm.System.gc()


NO_ID = -(2**63)  # stands for a null id on the way through pandas, which would turn a column with nulls into floats


def solid(key: Column | str) -> Column:
    """The id as long, NO_ID for null."""
    return F.coalesce((F.col(key) if isinstance(key, str) else key).cast("long"), F.lit(NO_ID).cast("long"))


def or_null(key: str) -> Column:
    """The id again, null for NO_ID."""
    return F.nullif(F.col(key), F.lit(NO_ID).cast("long"))


def bucket_of(col: Column, n: int) -> Column:
    """A bucket from 0 to n-1 by a hash of col."""
    return F.pmod(F.xxhash64(col), F.lit(n)).cast("int")


def id_crc(doc_id: Column) -> Column:
    """crc32 of the id written as text, the key of every held-out split."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def hash_cut(count: int, bound: int) -> int:
    """The 64-bit hash below which about bound of count rows lie, however many there are."""
    return -(2**63) + max(1, 2**64 * bound // count) if count > bound else 2**63 - 1


def sampled(rows: DataFrame, key: Column, count: int, bound: int) -> DataFrame:
    """About bound of count rows, by a hash of key: the same rows on every run and partitioning.

    Where too many rows share a key for that (none or far too many would be taken), bound rows in Spark's order.
    """
    if count <= bound:
        return rows
    picked = rows.where(F.xxhash64(key, F.lit("sample")) < F.lit(hash_cut(count, bound)))
    n = picked.count()
    return picked if 0 < n <= 2 * bound + 100 else (picked if n else rows).limit(bound)


def slices(sizes: Sequence[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive runs (from, to) of items whose sizes sum up to limit; a larger item runs alone."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finalizer over uint64 values (multiply, shift, xor)."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))
