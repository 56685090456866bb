"""Session settings that every millrace job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | None = None, partitions: int | None = None) -> SparkSession:
    """A local session for tests and the bench; on a cluster, pass your own."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{n}]")
        .appName("millrace")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions or n))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Only a session on one machine may go without: it gets a folder of its own. On a cluster that is an error.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if found is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-shared-"))
        found = context.getCheckpointDir()
    return found.rstrip("/")


def saved(df: DataFrame) -> DataFrame:
    """A checkpoint of df in the shared folder."""
    folder, context = shared_dir(df.sparkSession), df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """df written as Parquet into the shared folder and read again: the lineage ends here, and Spark knows its size."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, buckets: int, name: str = "bucketed") -> tuple[DataFrame, str]:
    """df written into the shared folder in buckets by key, and the path: joins and groups by key read it without a shuffle."""
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(df.sparkSession)}/{table}"
    df.write.bucketBy(buckets, key).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table), path


ROWS = 250_000  # of a partition that dealt makes


def parts_for(df: DataFrame, rows: int = ROWS) -> int:
    """How many partitions of about `rows` rows df fills; small tables get one per core."""
    return max(-(-df.count() // rows), df.sparkSession.sparkContext.defaultParallelism)


def dealt(df: DataFrame, keys: list[str], rows: int = ROWS) -> DataFrame:
    """df partitioned by keys, about `rows` rows a partition; the number is given, so that nothing merges partitions later."""
    return df.repartition(parts_for(df, rows), *keys)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once per application, for those that do not have it on their path."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="millrace-")) / "millrace.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"millrace/{f.relative_to(root)}")
    spark.sparkContext.addPyFile(str(path))
