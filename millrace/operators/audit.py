"""The audit log: entries appended as Parquet, and its latest ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR_LENGTH = 500


def entries(rows: DataFrame, action: str, table: Column, run: Column, at: Column, details: dict[str, Column] | None = None, actor: str = "pipeline") -> DataFrame:
    """An entry per row; details become JSON without null fields, none at all null. Texts of details are cut at ERROR_LENGTH."""
    cut = [F.substring(c, 1, ERROR_LENGTH).alias(n) if rows.select(c).schema[0].dataType.typeName() == "string" else c.alias(n) for n, c in (details or {}).items()]
    json = F.to_json(F.struct(*cut)) if cut else F.lit(None).cast("string")
    return rows.select(run.cast("long").alias("run_id"), table.cast("string").alias("table_name"), F.lit(action).alias("action"), json.alias("details"), F.lit(actor).alias("actor"), at.cast("timestamp").alias("created_at"))


def append(log: DataFrame, path: str) -> None:
    log.write.mode("append").parquet(path)


def recent(log: DataFrame, table: str | None = None, limit: int = 50) -> DataFrame:
    """The latest entries, of one table or of all; ties by action, run and details. Entries without a time come last."""
    kept = log if table is None else log.where(F.col("table_name") == table)
    return kept.orderBy(F.desc_nulls_last("created_at"), "action", "run_id", "details").limit(limit)
