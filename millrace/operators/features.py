"""Features, rule labels and exploratory statistics of employees, routes and items.

Rows with a null grouping key take no part: a summary of nobody is no feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import days_between, r6, safe_div
from millrace.operators.selection import quantile


def employee_features(daily: DataFrame, ref_date: str, hours: int = 8, formula: str = "hours") -> DataFrame:
    """formula "hours": working seconds per operation; "duration": recorded seconds per operation."""
    agg = daily.where("employee_id is not null and employee_name is not null").groupBy("employee_id", "employee_name").agg(
        F.sum("total_operations").alias("total_operations"), r6(F.sum("total_duration")).alias("total_duration"), r6(F.avg("avg_duration")).alias("avg_duration"),
        F.countDistinct("operation_date").alias("days_active"), F.min("operation_date").alias("first_operation"), F.max("operation_date").alias("last_operation"), F.count("total_operations").alias("operation_count"))
    agg = agg.withColumn("total_hours", F.col("days_active") * hours)
    spent = F.col("total_hours") * 3600 if formula == "hours" else F.col("total_duration")
    return agg.withColumns({"scan_interval": r6(safe_div(spent, F.col("total_operations"))), "scans_per_hour": r6(safe_div(F.col("total_operations"), F.col("total_hours"))), "time_since_last_scan": days_between(F.col("last_operation"), F.lit(ref_date).cast("timestamp"))})


def route_features(picking: DataFrame) -> DataFrame:
    agg = picking.where("picking_route_id is not null").groupBy("picking_route_id").agg(F.sum("total_picked").alias("total_picked"), F.sum("total_waste").alias("total_waste"), F.sum("operation_count").alias("operation_count"), F.countDistinct("item_id").alias("item_count"), F.avg("waste_rate").alias("avg_waste_rate"))
    agg = agg.withColumns({"error_rate": r6(safe_div(F.col("total_waste"), F.col("total_picked"))), "picked_per_operation": r6(safe_div(F.col("total_picked"), F.col("operation_count")))})
    return agg.withColumns({c: r6(c) for c in ("total_picked", "total_waste", "avg_waste_rate")})


def item_features(picking: DataFrame, marking: DataFrame | None) -> DataFrame:
    agg = picking.where("item_id is not null").groupBy("item_id").agg(F.sum("total_picked").alias("total_picked"), F.sum("total_waste").alias("total_waste"), F.countDistinct("picking_route_id").alias("route_count"), F.avg("waste_rate").alias("avg_waste_rate"))
    agg = agg.withColumn("error_rate", r6(safe_div(F.col("total_waste"), F.col("total_picked")))).withColumns({c: r6(c) for c in ("total_picked", "total_waste", "avg_waste_rate")})
    if marking is None:
        return agg.withColumns({"competitor_ratio": F.lit(0.0), "unique_marks": F.lit(0).cast("long")})
    marks = marking.where("item_id is not null").groupBy("item_id").agg(F.sum("usage_count").alias("mark_usage_count"), r6(F.sum("total_picked")).alias("mark_total_picked"), F.countDistinct("mark_code").alias("unique_marks"))
    marks = marks.withColumn("competitor_ratio", r6(safe_div(F.col("mark_usage_count"), F.col("mark_total_picked"))))
    return agg.join(marks, "item_id", "left").na.fill(0)


def rule_labels(features: DataFrame, entity: str) -> DataFrame:
    rule = {"employee": (F.col("scan_interval") < 2) | (F.col("scan_interval") > 300) | (F.col("time_since_last_scan") > 30), "route": F.col("error_rate") > 0.3, "item": F.col("error_rate") > 0.5}[entity]
    return features.withColumn("is_anomaly", F.when(rule, 1).otherwise(0))


def label_summary(labels: DataFrame, entity: str) -> DataFrame:
    return labels.agg(F.count("*").alias("total"), F.coalesce(F.sum("is_anomaly"), F.lit(0)).alias("anomalies")).select(F.lit(entity).alias("entity"), "total", "anomalies", r6(100 * safe_div(F.col("anomalies"), F.col("total"))).alias("pct"))


def daily_series(daily: DataFrame) -> DataFrame:
    """Operations, employees and mean duration per day, with the mean over seven rows (null before the seventh).

    The series has a row per day; the window without partitions runs over those alone.
    """
    days = daily.where("operation_date is not null").groupBy("operation_date").agg(F.sum("total_operations").alias("operations"), F.countDistinct("employee_id").alias("employees"), r6(F.avg("avg_duration")).alias("avg_duration"))
    return moving_mean(days, "operations", 7, ["operation_date"])


def moving_mean(df: DataFrame, col: str, n: int, order: list[str], keys: list[str] = ()) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(n - 1), 0)
    return df.withColumn(f"{col}_ma{n}", F.when(F.count(F.lit(1)).over(w) == n, r6(F.avg(col).over(w))))


def zscore(df: DataFrame, col: str, keep: float | None = None) -> DataFrame:
    """Sample z-score against all rows: one aggregate row, broadcast; keep drops rows within that many deviations."""
    stats = df.agg(F.avg(col).alias("_mean"), F.stddev_samp(col).alias("_std"))
    out = df.crossJoin(F.broadcast(stats)).withColumn("z", (F.col(col) - F.col("_mean")) / F.nullif(F.col("_std"), F.lit(0.0)))
    return (out.where(F.abs("z") > keep) if keep is not None else out).drop("_std")


def unusual_days(series: DataFrame, sigma: float = 2.0) -> DataFrame:
    out = zscore(series, "operations", sigma)
    return out.select("operation_date", "operations", r6(F.col("operations") - F.col("_mean")).alias("deviation"), r6("z").alias("sigma"), F.when(F.col("z") > 0, "High").otherwise("Low").alias("kind"))


def duration_outliers(daily: DataFrame, z: float = 2.0) -> DataFrame:
    by = daily.where("employee_id is not null").groupBy("employee_id").agg(F.avg("avg_duration").alias("duration"))
    return zscore(by, "duration", z).select("employee_id", r6("duration").alias("duration"), r6("z").alias("z"))


def top_k(df: DataFrame, order: list, k: int) -> DataFrame:
    """The first k rows; order ends in a key, so ties are settled."""
    return df.orderBy(*order).limit(k)


def item_waste(picking: DataFrame, min_pickings: int = 5) -> DataFrame:
    out = picking.where("item_id is not null").groupBy("item_id").agg(F.sum("total_picked").alias("picked"), F.sum("total_waste").alias("waste"), F.count("*").alias("pickings")).where(F.col("pickings") >= min_pickings)
    return out.withColumn("waste_rate", F.col("waste") / (F.col("picked") + F.col("waste") + 1e-10))


def route_efficiency(picking: DataFrame) -> DataFrame:
    out = picking.where("picking_route_id is not null").groupBy("picking_route_id").agg(F.sum("total_picked").alias("picked"), F.sum("total_waste").alias("waste"))
    return out.withColumn("efficiency", r6(F.col("picked") / (F.col("picked") + F.col("waste") + 1e-10)))


def waste_above(picking: DataFrame, threshold: float) -> DataFrame:
    out = picking.where(F.col("item_id").isNotNull() & (F.col("waste_rate") >= threshold)).groupBy("item_id").agg(F.count("*").alias("n"), r6(F.sum("total_waste")).alias("waste"))
    return out


def zero_pick_routes(picking: DataFrame) -> DataFrame:
    return picking.where("picking_route_id is not null").groupBy("picking_route_id").agg(F.sum("total_picked").alias("picked"), F.sum("total_waste").alias("waste")).where("picked = 0 and waste > 0")


def low_pick_high_waste(items: DataFrame, rate: float) -> DataFrame:
    """Items below the first quartile of picks (linear between ranks) with a waste rate above `rate`."""
    return items.where((F.col("picked") < quantile(items, "picked", 0.25)) & (F.col("waste_rate") > rate))


def mark_usage(marking: DataFrame) -> DataFrame:
    out = marking.where("mark_code is not null").groupBy("mark_code").agg(F.countDistinct("item_id").alias("items"), F.sum("usage_count").alias("usage"), F.sum("total_picked").alias("picked"))
    return out.select("mark_code", "items", "usage", r6("picked").alias("picked"), r6(safe_div(F.col("picked"), F.col("usage"))).alias("picked_per_use"))


def streaks(ops: DataFrame, bad: str) -> DataFrame:
    """Longest unbroken run of operations of type `bad` per employee, and the number of runs over five."""
    w = Window.partitionBy("employee_id").orderBy("start_time", "operation_id")
    flagged = ops.where("employee_id is not null").withColumn("bad", F.col("operation_type") == bad).withColumn("isle", F.row_number().over(w) - F.sum(F.when(F.col("bad"), 1).otherwise(0)).over(w))
    runs = flagged.where("bad").groupBy("employee_id", "isle").agg(F.count("*").alias("n"))
    return runs.groupBy("employee_id").agg(F.max("n").alias("longest"), F.count_if(F.col("n") > 5).alias("over_five"))


def scan_gaps(ops: DataFrame) -> DataFrame:
    """Seconds between an employee's scans: share below two, least, median and mean."""
    w = Window.partitionBy("employee_id").orderBy("start_time", "operation_id")
    gap = F.unix_micros(F.col("start_time").cast("timestamp")) / 1e6
    g = ops.where("employee_id is not null").withColumn("gap", gap - F.lag(gap).over(w)).where("gap is not null")
    return g.groupBy("employee_id").agg(r6(F.avg(F.when(F.col("gap") < 2, 1.0).otherwise(0.0))).alias("share_fast"), r6(F.min("gap")).alias("min_gap"), r6(F.median("gap")).alias("median_gap"), r6(F.avg("gap")).alias("mean_gap"))


def growth(df: DataFrame, over: float) -> DataFrame:
    """Competitor codes per month and the months in which they grew by more than `over`."""
    m = df.where("competitor").groupBy(F.trunc("mark_date", "month").alias("month")).agg(F.count("*").alias("codes"))
    prev = F.lag("codes").over(Window.orderBy("month"))
    return m.withColumn("previous", prev).withColumn("growing", F.coalesce(F.col("codes") > F.col("previous") * (1 + over), F.lit(False)))


def own_history(daily: DataFrame) -> DataFrame:
    """Each employee's day against the mean of the days before."""
    by = daily.where("employee_id is not null").groupBy("employee_id", "operation_date").agg(F.sum("total_operations").alias("operations"))
    w = Window.partitionBy("employee_id").orderBy("operation_date").rowsBetween(Window.unboundedPreceding, -1)
    return by.withColumn("deviation", r6(F.col("operations") - F.avg("operations").over(w)))
