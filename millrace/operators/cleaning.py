"""All-text extracts to typed tables: column mappings, schema sync and rejects."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What each source type becomes; types that are not named stay text, and so do all dates.
TYPE_MAP = {
    "int": "int", "bigint": "bigint", "smallint": "smallint", "tinyint": "smallint", "bit": "boolean", "decimal": "decimal(38,10)", "numeric": "decimal(38,10)",
    "money": "decimal(19,4)", "smallmoney": "decimal(10,4)", "float": "double", "real": "float", "varbinary": "binary", "binary": "binary", "image": "binary",
}


def apply_mapping(df: DataFrame, mapping: list[tuple[str, str]]) -> DataFrame:
    """(target, Spark SQL expression) pairs, in order."""
    return df.selectExpr(*[f"{e} AS {t}" for t, e in mapping])


def cast_by_map(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns cast to the Spark type of their source type; values that do not fit are null."""
    return df.select(*[F.btrim(F.col(c)).try_cast(TYPE_MAP.get(types[c], "string")).alias(c) if c in types else F.col(c) for c in df.columns])


def select_ci(df: DataFrame, names: list[str]) -> DataFrame:
    """Columns by name whatever their case, under the names asked for; unknown names are skipped."""
    found = {c.lower(): c for c in df.columns}
    return df.select(*[F.col(found[n.lower()]).alias(n) for n in names if n.lower() in found])


def sync_schema(df: DataFrame, target: list[str]) -> DataFrame:
    """The target's columns in its order: missing ones as null text, others left out."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[F.col(have[t.lower()]).alias(t) if t.lower() in have else F.lit(None).cast("string").alias(t) for t in target])


def with_row_id(df: DataFrame, order: list[str], name: str = "row_id") -> DataFrame:
    """Row numbers by order, made in parallel: ranges are sorted apart and shifted by the counts before them.

    Ties in order are settled by the other columns, so the numbers do not depend on the partitioning.
    """
    keys = [*order, *[c for c in df.columns if c not in order]]
    ranged = df.repartitionByRange(*keys).withColumn("_p", F.spark_partition_id())
    own = Window.partitionBy("_p").orderBy(*keys)
    counts = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return ranged.withColumn("_r", F.row_number().over(own)).join(F.broadcast(before), "_p").withColumn(name, F.col("_before") + F.col("_r")).drop("_p", "_r", "_before")


def decode_bytes(df: DataFrame, col: str, encodings: list[str]) -> DataFrame:
    """Text from bytes by the first encoding that fits; bytes that fit none are null.

    If UTF-8 is the first, Spark itself decodes what is valid, and Python gets the other rows' bytes alone.
    """

    @F.pandas_udf("string")
    def decode(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(b):
            for e in encodings if b is not None else ():
                try:
                    return bytes(b).decode(e)
                except UnicodeDecodeError:
                    continue
            return None

        for part in values:
            yield part.map(one)

    if not encodings or encodings[0].lower().replace("_", "-") not in ("utf-8", "utf8"):
        return df.withColumn(col, decode(F.col(col)))
    text = F.try_validate_utf8(F.col(col).cast("string"))
    return df.withColumn(col, F.coalesce(text, decode(F.when(text.isNull(), F.col(col)))))


def split_rejects(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows as JSON with the first reason): a row is rejected if a rule holds for it."""
    reason = F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in rules.items()])
    marked = df.withColumn("_reason", reason)
    return marked.where("_reason is null").drop("_reason"), marked.where("_reason is not null").select(F.to_json(F.struct(*df.columns)).alias("row_json"), F.col("_reason").alias("reason"))
