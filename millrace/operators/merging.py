"""Set operations and merges by key, from DataFrames to a new version of the target."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedupe_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key by order. Rows with a null key part conflict with nothing and all stay."""
    null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    return _first(df.where(~null), keys, order).unionByName(df.where(null))


def _first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def merge_wins(dfs: list[DataFrame], keys: list[str], last: bool = True) -> DataFrame:
    """Union of several results; of rows with one key, the last (or first) frame's stays."""
    both = reduce(lambda a, b: a.unionByName(b), [df.withColumn("_priority", F.lit(i)) for i, df in enumerate(dfs)])
    others = [c for c in dfs[0].columns if c not in keys]
    return dedupe_first(both, keys, [F.desc("_priority") if last else F.asc("_priority"), *others]).drop("_priority")


def key_diff(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that only one side has: missing (only in a) and extra (only in b); null equals null."""
    x, y = a.select(*keys), b.select(*keys)
    return x.subtract(y).withColumn("side", F.lit("missing")).unionByName(y.subtract(x).withColumn("side", F.lit("extra")))


def _row(side: str, cols: list[str]) -> Column:
    return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in cols])


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], *, action: str = "update", compare: list[str] | None = None, order: list | None = None) -> DataFrame:
    """The merged rows with a column `_change`: inserted, updated, unchanged, conflicted, or kept (not in the batch).

    action "nothing" keeps the target's row; "update" takes the batch's row if a column of compare differs (all others by
    default, null-safe; [] means always). Of batch rows with one key, the first by order counts (columns descending by
    default). Null keys never conflict: such rows are inserted. One shuffle by key on each side: the batch is deduplicated
    and joined in the same partitioning.
    """
    others = [c for c in target.columns if c not in keys]
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    rows = batch.select(*target.columns)
    first = _first(rows.where(known), keys, order or [F.desc(c) for c in others])
    t, b = target.where(known).withColumn("_t", F.lit(1)).alias("t"), first.withColumn("_b", F.lit(1)).alias("b")
    both = t.join(b, reduce(Column.__and__, [F.col(f"t.{k}") == F.col(f"b.{k}") for k in keys]), "full_outer")
    tested = others if compare is None else compare
    differs = ~_row("t", tested).eqNullSafe(_row("b", tested)) if tested else F.lit(True)
    change = F.when(F.col("_b").isNull(), "kept").when(F.col("_t").isNull(), "inserted").when(F.lit(action == "nothing"), "conflicted").when(differs, "updated").otherwise("unchanged")
    take = F.col("_change").isin("inserted", "updated")
    merged = both.withColumn("_change", change).select(*[F.when(take, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns], "_change")
    return merged.unionByName(target.where(~known).withColumn("_change", F.lit("kept"))).unionByName(rows.where(~known).withColumn("_change", F.lit("inserted")))


def changes(merged: DataFrame) -> DataFrame:
    """Counts of inserted, updated, unchanged and conflicted rows of an upsert."""
    return merged.agg(*[F.count_if(F.col("_change") == c).alias(c) for c in ("inserted", "updated", "unchanged", "conflicted")])


def accumulate(state: DataFrame, batch: DataFrame, key: str, sums: list[str]) -> DataFrame:
    """Running totals: old plus new by key."""
    return state.select(key, *sums).unionByName(batch.select(key, *sums)).groupBy(key).agg(*[F.sum(c).alias(c) for c in sums])


def changed_since(df: DataFrame, ts: str, last) -> DataFrame:
    """Rows after the watermark; without one, everything."""
    return df if last is None else df.where(F.col(ts) > F.lit(last).cast(df.schema[ts].dataType))


def after_cursor(df: DataFrame, ts: str, key: str, last_ts, last_key) -> DataFrame:
    """Rows after (last_ts, last_key) in the order of both."""
    at = F.lit(last_ts).cast(df.schema[ts].dataType)
    return df.where((F.col(ts) > at) | ((F.col(ts) == at) & (F.col(key) > last_key)))
