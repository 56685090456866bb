"""Summaries of warehouse operations, by item, route, order, customer, vendor and day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import r6, safe_div, seconds_between
from millrace.operators.sweep import running_total
from millrace.session import stored

QUARTILES = (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))


def _ones(c: str):
    return F.count_if(F.col(c))


def serial_mark_stats(df: DataFrame) -> DataFrame:
    return df.where("item_id is not null").groupBy("item_id", "mark_code").agg(F.count("*").alias("total_serials"), _ones("accepted").alias("accepted_count"), _ones("blocked").alias("blocked_count"), _ones("is_defect").alias("defect_count"), F.min("mark_date").alias("first_mark_date"), F.max("mark_date").alias("last_mark_date"))


def picking_route_summary(route: DataFrame, task: DataFrame) -> DataFrame:
    """Tasks are summed by route before the join, so a route with many tasks moves one row."""
    tasks = task.groupBy("picking_route_id").agg(F.count("task_id").alias("total_tasks"), F.sum("picked_qty").alias("picked"), F.sum("waste_qty").alias("waste"))
    keys = ["picking_route_id", "employee_id", "employee_name", "start_date", "end_date"]
    rows = route.where("picking_route_id is not null").groupBy(*keys).agg(F.count("*").alias("n")).join(tasks, "picking_route_id", "left")
    return rows.select("picking_route_id", "employee_id", "employee_name", (F.coalesce("total_tasks", F.lit(0)) * F.col("n")).alias("total_tasks"), r6(F.coalesce(F.col("picked") * F.col("n"), F.lit(0.0))).alias("total_picked"), r6(F.coalesce(F.col("waste") * F.col("n"), F.lit(0.0))).alias("total_waste"), seconds_between(F.col("start_date"), F.col("end_date")).alias("route_duration"), "start_date", "end_date")


def order_trans_stats(df: DataFrame) -> DataFrame:
    return df.where("order_id is not null").groupBy("order_id").agg(F.count("*").alias("total_items"), r6(F.sum("qty")).alias("total_qty"), r6(F.sum("picked_qty")).alias("total_picked"), r6(F.sum("waste_qty")).alias("total_waste"), F.min("created_datetime").alias("first_trans_date"), F.max("created_datetime").alias("last_trans_date"))


def _account_summary(df: DataFrame, account: str, number: str, date: str, count_as: str) -> DataFrame:
    return df.where(F.col(account).isNotNull()).groupBy(account).agg(F.countDistinct(number).alias("total_orders"), F.count("*").alias(count_as), F.min(date).alias("first_order_date"), F.max(date).alias("last_order_date"), F.array_join(F.array_sort(F.collect_set("currency_code")), ", ").alias("currencies_used"))


def sales_summary(df: DataFrame) -> DataFrame:
    return _account_summary(df, "customer_account", "sales_id", "invoice_date", "total_sales")


def purchase_summary(df: DataFrame) -> DataFrame:
    return _account_summary(df, "vendor_account", "purchase_id", "order_date", "total_purchases")


def pack_task_stats(df: DataFrame) -> DataFrame:
    return df.where("picking_route_id is not null").groupBy("picking_route_id").agg(F.count("*").alias("total_tasks"), r6(F.sum("qty")).alias("total_qty"), r6(F.sum("picked_qty")).alias("total_picked"), r6(F.sum("waste_qty")).alias("total_waste"), r6(F.avg("qty")).alias("avg_qty_per_task"))


def daily_operations(df: DataFrame) -> DataFrame:
    return df.groupBy(F.to_date("start_time").alias("operation_date"), "employee_id", "employee_name", "operation_type").agg(F.count("*").alias("total_operations"), F.sum("duration_seconds").alias("total_duration"), F.avg("duration_seconds").alias("avg_duration"))


def picking_efficiency(df: DataFrame) -> DataFrame:
    out = df.groupBy("picking_route_id", "item_id").agg(F.sum("picked_qty").alias("total_picked"), F.sum("waste_qty").alias("total_waste"), F.count("*").alias("operation_count"))
    return out.withColumn("waste_rate", safe_div(F.col("total_waste"), F.col("total_picked")))


def marking_statistics(df: DataFrame) -> DataFrame:
    return df.groupBy("mark_code", "item_id").agg(F.count("*").alias("usage_count"), F.sum("picked_qty").alias("total_picked"))


def marking_codes(df: DataFrame, by: str) -> DataFrame:
    """Codes, competitor codes, blocked codes and first and last date, by item or by day."""
    key = F.to_date("mark_date").alias("mark_day") if by == "day" else F.col("item_id")
    return df.groupBy(key).agg(F.count("*").alias("total_codes"), _ones("competitor").alias("competitor_count"), _ones("blocked").alias("blocked_count"), F.min("mark_date").alias("first_date"), F.max("mark_date").alias("last_date"))


def count_with_span(df: DataFrame, key: str, date: str) -> DataFrame:
    """Rows with first and last date by key (act types, route statuses)."""
    return df.groupBy(key).agg(F.count("*").alias("total"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def journal_by_day(df: DataFrame) -> DataFrame:
    return df.groupBy("employee_id", F.to_date("start_time").alias("operation_date")).agg(F.count("*").alias("operations"), r6(F.sum("duration_seconds")).alias("total_qty"), r6(F.avg("duration_seconds")).alias("avg_duration"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(tbl, rows) of every table: one small aggregate each, unioned."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("tbl"), "rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n"))


def pivot_sum(df: DataFrame, row: str, col: str, val: str, values: list) -> DataFrame:
    """Sums of val, one column per value of col; naming the values saves a pass over the data."""
    return df.groupBy(row).agg(*[r6(F.sum(F.when(F.col(col) == v, F.col(val)))).alias(f"{col}_{v}") for v in values])


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per column; quartiles are exact, linear between ranks.

    Values are counted, and the counts added up in the order of the values over range partitions: no task gets a whole column.
    """
    each = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])))
    stats = each.groupBy("column").agg(F.count("value").alias("count"), r6(F.avg("value")).alias("mean"), r6(F.stddev_samp("value")).alias("std"), r6(F.min("value")).alias("min"), r6(F.max("value")).alias("max"))
    counts = each.where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    order = F.array_position(F.array(*map(F.lit, cols)), F.col("column"))
    upto = running_total(counts.withColumn("_at", order), ["_at", "value"], "n")  # ranks run through all columns
    ends = stored(upto.groupBy("column").agg(F.min(F.col("running") - F.col("n")).alias("_before"), F.sum("n").alias("_n")), "ends")
    spots = F.array(*[F.struct(F.lit(name).alias("name"), ((F.col("_n") - 1) * share).alias("at")) for name, share in QUARTILES])
    ranks = ends.select("column", "_before", F.inline(spots)).withColumns({"_low": F.floor("at"), "_high": F.ceil("at")})
    held = upto.join(F.broadcast(ranks), "column")  # three rows a column
    place = lambda rank: (F.col("running") - F.col("n") <= F.col("_before") + F.col(rank)) & (F.col("_before") + F.col(rank) < F.col("running"))
    ends_of = held.groupBy("column", "name", "at", "_low", "_high").agg(F.max(F.when(place("_low"), F.col("value"))).alias("_a"), F.max(F.when(place("_high"), F.col("value"))).alias("_b"))
    value = F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise((F.col("_high") - F.col("at")) * F.col("_a") + (F.col("at") - F.col("_low")) * F.col("_b"))
    quartiles = ends_of.groupBy("column").agg(*[r6(F.max(F.when(F.col("name") == name, value))).alias(name) for name, _ in QUARTILES])
    every = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    out = every.join(stats, "column", "left").join(quartiles, "column", "left").fillna(0, ["count"])
    return out.select("column", "count", "mean", "std", "min", *[name for name, _ in QUARTILES], "max")


def profile_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """total, non-blank, null share, distinct values and the keep-or-drop decision per column, in one pass."""
    stats = []
    for c in cols:
        x = F.nullif(F.btrim(F.col(c).cast("string")), F.lit(""))
        stats.append(F.struct(F.lit(c).alias("column"), F.count("*").alias("total"), F.count(x).alias("non_blank"), F.countDistinct(x).alias("distinct_values")))
    flat = df.agg(F.array(*stats).alias("r")).select(F.inline("r"))
    share = F.when(F.col("total") > 0, 100.0 * (F.col("total") - F.col("non_blank")) / F.col("total")).otherwise(0.0)
    empty = (share > 95) | ((F.col("distinct_values") <= 1) & (F.col("total") > 0))
    return flat.withColumn("null_pct", r6(share)).withColumn("decision", F.when(empty, "empty").otherwise("keep"))


def binary_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Confusion matrix, precision, recall and F1; a zero denominator gives 0."""
    n = lambda a, b: F.count_if((F.col(y) == a) & (F.col(yhat) == b))
    m = df.agg(n(1, 1).alias("tp"), n(0, 1).alias("fp"), n(1, 0).alias("fn"), n(0, 0).alias("tn"))
    m = m.withColumn("precision", safe_div(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", safe_div(F.col("tp"), F.col("tp") + F.col("fn")))
    return m.withColumn("f1", safe_div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
