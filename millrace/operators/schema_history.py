"""Schemas read from the rows of all-text extracts, and their versions.

A column's type is the least of bigint < decimal < text or timestamp < text that takes all its values. Whether a value
fits a type is a flag, and flags of partitions are merged by AND, so one pass over the extract types all columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HISTORY = "table_name string, version int, fingerprint string, columns array<struct<position:int,name:string,type:string>>"

# Fixed forms of values: whole numbers below 10^18, decimals, and dates with or without a time.
WHOLE = r"^[+-]?[0-9]{1,18}$"
DECIMAL = r"^[+-]?([0-9]{1,20}(\.[0-9]{0,18})?|\.[0-9]{1,18})$"
TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?)?$"


def _fits(v: Column) -> dict[str, Column]:
    return {"whole": v.rlike(WHOLE), "decimal": v.rlike(DECIMAL), "time": F.when(v.isNotNull(), v.rlike(TIME) & v.try_cast("timestamp_ntz").isNotNull())}


def inferred_types(df: DataFrame, table: str) -> DataFrame:
    """(table_name, position, column_name, data_type, filled) of an all-text extract; blank values say nothing.

    A column without values is "void", as is every column of an empty extract. Other columns than text are cast to text.
    """
    parts = []
    for i, c in enumerate(df.columns):
        text = F.btrim(F.col(f"`{c}`").cast("string"))
        v = F.when(text != "", text)
        fits = {n: F.coalesce(F.bool_and(x), F.lit(True)) for n, x in _fits(v).items()}
        kind = F.when(F.count(v) == 0, "void").when(fits["whole"], "bigint").when(fits["decimal"], "decimal").when(fits["time"], "timestamp").otherwise("text")
        parts.append(F.struct(F.lit(table).alias("table_name"), F.lit(i + 1).alias("position"), F.lit(c).alias("column_name"), kind.alias("data_type"), F.count(v).alias("filled")))
    return df.agg(F.array(*parts).alias("r")).select(F.inline("r"))


def _versioned(types: DataFrame) -> DataFrame:
    """One row per table: its columns in order and their fingerprint."""
    columns = F.array_sort(F.collect_list(F.struct(F.col("position"), F.col("column_name").alias("name"), F.col("data_type").alias("type"))))
    lines = F.array_join(F.transform("columns", lambda x: F.concat(F.to_json(F.struct(x["name"], x["type"])))), "\n")
    return types.groupBy("table_name").agg(columns.alias("columns")).withColumn("fingerprint", F.sha2(lines, 256))


def record_version(history: DataFrame, types: DataFrame) -> DataFrame:
    """The rows to append to history: tables whose fingerprint differs from that of their last version, or that are new.

    The number is the table's greatest one plus 1, from 1. A schema that comes back after another one is a version again.
    """
    last = history.groupBy("table_name").agg(F.max("version").alias("_n"), F.max_by("fingerprint", "version").alias("_last"))
    now = _versioned(types).join(last, "table_name", "left").where(~F.col("fingerprint").eqNullSafe(F.col("_last")))
    return now.select("table_name", (F.coalesce("_n", F.lit(0)) + 1).alias("version"), "fingerprint", "columns")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The recorded versions; none if nothing was recorded."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(HISTORY).parquet(path) if there else spark.createDataFrame([], HISTORY)


def append_version(spark: SparkSession, path: str, types: DataFrame) -> None:
    """Record the schemas' versions in a Parquet folder. Recording the same schemas again adds nothing."""
    record_version(read_history(spark, path), types).coalesce(1).write.mode("append").parquet(path)


def schema_history(history: DataFrame) -> DataFrame:
    """Every version with its drift from the one before: the names added, removed and of another type, comma-joined.

    A type change outranks a removal, a removal an addition; the first version is new_table; other orders of the same
    columns give a version without a drift type. Sort by table and descending version to list them.
    """
    before = Window.partitionBy("table_name").orderBy("version")
    h = history.withColumn("_old", F.lag("columns").over(before))
    names = lambda c: F.transform(c, lambda x: x["name"])
    joined = lambda c: F.coalesce(F.array_join(F.array_sort(c), ","), F.lit(""))
    pairs = lambda c: F.transform(c, lambda x: F.struct(x["name"].alias("name"), x["type"].alias("type")))
    both = F.array_intersect(names(F.col("columns")), names(F.col("_old")))
    same = names(F.array_intersect(pairs(F.col("columns")), pairs(F.col("_old"))))
    h = h.withColumns({
        "added": joined(F.array_except(names(F.col("columns")), names(F.col("_old")))),
        "removed": joined(F.array_except(names(F.col("_old")), names(F.col("columns")))),
        "type_changes": joined(F.array_except(both, same)),
    })
    kind = F.when(F.col("_old").isNull(), "new_table").when(F.col("type_changes") != "", "type_changed").when(F.col("removed") != "", "columns_removed").when(F.col("added") != "", "columns_added")
    listed = F.array_join(F.transform("columns", lambda x: F.concat(x["name"], F.lit(":"), x["type"])), ",")
    return h.select("table_name", "version", "fingerprint", listed.alias("columns"), kind.alias("drift_type"), "added", "removed", "type_changes")
