"""Queries of the features, labels and exploratory statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.columns import map_code, r6
from millrace.operators import features as x
from millrace.operators.marts import value_counts
from millrace.plans.registry import query
from millrace.sources.adapters import view

REF = "2024-02-15"
LABELS = {"click": "Scan", "view": "Look-up", "purchase": "Pick", "signup": "Shift start"}

_EMPLOYEE = f"""
SELECT employee_id, employee_name, CAST(sum(total_operations) AS BIGINT) AS total_operations, round(sum(total_duration), 6) AS total_duration, round(avg(avg_duration), 6) AS avg_duration,
       count(DISTINCT operation_date) AS days_active, min(operation_date) AS first_operation, max(operation_date) AS last_operation,
       count(total_operations) AS operation_count, count(DISTINCT operation_date) * 8 AS total_hours,
       round(%s / sum(total_operations), 6) AS scan_interval,
       round(sum(total_operations) / (count(DISTINCT operation_date) * 8), 6) AS scans_per_hour,
       date_diff('day', max(operation_date), DATE '{REF}') AS time_since_last_scan
FROM {{daily}} GROUP BY employee_id, employee_name"""
_HOURS = _EMPLOYEE % "(count(DISTINCT operation_date) * 8 * 3600)"
_ROUTE = """
SELECT picking_route_id, round(sum(total_picked), 6) AS total_picked, round(sum(total_waste), 6) AS total_waste,
       CAST(sum(operation_count) AS BIGINT) AS operation_count, count(DISTINCT item_id) AS item_count, round(avg(waste_rate), 6) AS avg_waste_rate,
       round(sum(total_waste) / sum(total_picked), 6) AS error_rate, round(sum(total_picked) / sum(operation_count), 6) AS picked_per_operation
FROM {picking} GROUP BY picking_route_id"""
_ITEM = """
SELECT p.*, CAST(coalesce(mark_usage_count, 0) AS BIGINT) AS mark_usage_count, coalesce(mark_total_picked, 0) AS mark_total_picked, coalesce(unique_marks, 0) AS unique_marks,
       coalesce(competitor_ratio, 0) AS competitor_ratio
FROM (SELECT item_id, round(sum(total_picked), 6) AS total_picked, round(sum(total_waste), 6) AS total_waste, count(DISTINCT picking_route_id) AS route_count,
             round(avg(waste_rate), 6) AS avg_waste_rate, round(sum(total_waste) / sum(total_picked), 6) AS error_rate FROM {picking} GROUP BY item_id) p
LEFT JOIN (SELECT item_id, sum(usage_count) AS mark_usage_count, round(sum(total_picked), 6) AS mark_total_picked, count(DISTINCT mark_code) AS unique_marks,
                  round(sum(usage_count) / sum(total_picked), 6) AS competitor_ratio FROM {marking} GROUP BY item_id) k ON k.item_id = p.item_id"""


def _employee(spark, d, formula="hours"):
    return x.employee_features(view(spark, d, "daily"), REF, formula=formula)


@query("x01_employee_features", _HOURS)
def x01(spark, d):
    return _employee(spark, d)


@query("x02_route_features", _ROUTE)
def x02(spark, d):
    return x.route_features(view(spark, d, "picking"))


@query("x03_item_features", _ITEM)
def x03(spark, d):
    return x.item_features(view(spark, d, "picking"), view(spark, d, "marking"))


@query("x04_employee_labels", f"SELECT *, CASE WHEN scan_interval < 2 OR scan_interval > 300 OR time_since_last_scan > 30 THEN 1 ELSE 0 END AS is_anomaly FROM ({_HOURS})")
def x04(spark, d):
    return x.rule_labels(_employee(spark, d), "employee")


@query("x04_route_labels", f"SELECT *, CASE WHEN error_rate > 0.3 THEN 1 ELSE 0 END AS is_anomaly FROM ({_ROUTE})")
def x04r(spark, d):
    return x.rule_labels(x02(spark, d), "route")


@query("x04_item_labels", f"SELECT *, CASE WHEN error_rate > 0.5 THEN 1 ELSE 0 END AS is_anomaly FROM ({_ITEM})")
def x04i(spark, d):
    return x.rule_labels(x03(spark, d), "item")


@query("x05_label_summary", f"""
SELECT 'employee' AS entity, count(*) AS total, CAST(sum(a) AS BIGINT) AS anomalies, round(100.0 * sum(a) / count(*), 6) AS pct FROM (SELECT CASE WHEN scan_interval < 2 OR scan_interval > 300 OR time_since_last_scan > 30 THEN 1 ELSE 0 END AS a FROM ({_HOURS}))
UNION ALL SELECT 'route', count(*), CAST(sum(a) AS BIGINT), round(100.0 * sum(a) / count(*), 6) FROM (SELECT CASE WHEN error_rate > 0.3 THEN 1 ELSE 0 END AS a FROM ({_ROUTE}))""")
def x05(spark, d):
    return x.label_summary(x04(spark, d), "employee").unionByName(x.label_summary(x04r(spark, d), "route"))


@query("x06_employee_features_by_duration", _EMPLOYEE % "round(sum(total_duration), 6)")
def x06(spark, d):
    return _employee(spark, d, "duration")


_SERIES = """
SELECT *, CASE WHEN count(*) OVER w = 7 THEN round(avg(operations) OVER w, 6) END AS operations_ma7
FROM (SELECT operation_date, CAST(sum(total_operations) AS BIGINT) AS operations, count(DISTINCT employee_id) AS employees, round(avg(avg_duration), 6) AS avg_duration FROM {daily} GROUP BY operation_date)
WINDOW w AS (ORDER BY operation_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""


@query("x07_daily_series", _SERIES)
def x07(spark, d):
    return x.daily_series(view(spark, d, "daily"))


@query("x08_unusual_days", f"""
SELECT operation_date, operations, round(operations - m, 6) AS deviation, round((operations - m) / s, 6) AS sigma, CASE WHEN operations > m THEN 'High' ELSE 'Low' END AS kind
FROM ({_SERIES}), (SELECT avg(operations) AS m, stddev_samp(operations) AS s FROM ({_SERIES})) WHERE abs((operations - m) / s) > 1.5""")
def x08(spark, d):
    return x.unusual_days(x07(spark, d), 1.5)


@query("x09_duration_outliers", """
SELECT employee_id, round(v, 6) AS duration, round((v - m) / s, 6) AS z
FROM (SELECT employee_id, avg(avg_duration) AS v FROM {daily} GROUP BY employee_id),
     (SELECT avg(v) AS m, stddev_samp(v) AS s FROM (SELECT employee_id, avg(avg_duration) AS v FROM {daily} GROUP BY employee_id)) WHERE abs((v - m) / s) > 2""")
def x09(spark, d):
    return x.duration_outliers(view(spark, d, "daily"))


_WASTE = "SELECT item_id, sum(total_picked) AS picked, sum(total_waste) AS waste, count(*) AS pickings, sum(total_waste) / (sum(total_picked) + sum(total_waste) + 1e-10) AS waste_rate FROM {picking} GROUP BY item_id HAVING count(*) >= 5"


def _rounded(items):
    return items.select("item_id", r6("picked").alias("picked"), r6("waste").alias("waste"), "pickings", r6("waste_rate").alias("waste_rate"))


@query("x10_item_waste", f"SELECT item_id, round(picked, 6) AS picked, round(waste, 6) AS waste, pickings, round(waste_rate, 6) AS waste_rate FROM ({_WASTE}) ORDER BY round(waste_rate, 6) DESC, item_id LIMIT 20")
def x10(spark, d):
    return x.top_k(_rounded(x.item_waste(view(spark, d, "picking"))), [F.desc("waste_rate"), "item_id"], 20)


_EFF = "SELECT picking_route_id, round(sum(total_picked), 6) AS picked, round(sum(total_waste), 6) AS waste, round(sum(total_picked) / (sum(total_picked) + sum(total_waste) + 1e-10), 6) AS efficiency FROM {picking} GROUP BY picking_route_id"


@query("x11_route_efficiency_ends", f"(SELECT 'top' AS place, * FROM ({_EFF}) ORDER BY efficiency DESC, picking_route_id LIMIT 20) UNION ALL (SELECT 'bottom', * FROM ({_EFF}) ORDER BY efficiency, picking_route_id LIMIT 20)")
def x11(spark, d):
    e = x.route_efficiency(view(spark, d, "picking")).withColumns({c: r6(c) for c in ("picked", "waste")})
    top, bottom = x.top_k(e, [F.desc("efficiency"), "picking_route_id"], 20), x.top_k(e, ["efficiency", "picking_route_id"], 20)
    return top.select(F.lit("top").alias("place"), "*").unionByName(bottom.select(F.lit("bottom").alias("place"), "*"))


@query("x12_waste_above", "SELECT item_id, count(*) AS n, round(sum(total_waste), 6) AS waste FROM {picking} WHERE waste_rate >= 0.095 GROUP BY item_id")
def x12(spark, d):
    return x.waste_above(view(spark, d, "picking"), 0.095)


@query("x13_zero_pick_routes", "SELECT picking_route_id, sum(p) AS picked, round(sum(w), 6) AS waste FROM (SELECT picking_route_id, item_id, CASE WHEN picking_route_id % 5 = 0 THEN 0.0 ELSE total_picked END AS p, total_waste AS w FROM {picking}) GROUP BY picking_route_id HAVING sum(p) = 0 AND sum(w) > 0")
def x13(spark, d):
    rows = view(spark, d, "picking").withColumn("total_picked", F.when(F.col("picking_route_id") % 5 == 0, 0.0).otherwise(F.col("total_picked")))
    return x.zero_pick_routes(rows).withColumn("waste", r6("waste"))


@query("x14_low_pick_high_waste", f"SELECT item_id, round(picked, 6) AS picked, round(waste, 6) AS waste, pickings, round(waste_rate, 6) AS waste_rate FROM ({_WASTE}) WHERE picked < (SELECT quantile_cont(picked, 0.25) FROM ({_WASTE})) AND waste_rate > 0.05")
def x14(spark, d):
    return _rounded(x.low_pick_high_waste(x.item_waste(view(spark, d, "picking")), 0.05))


@query("x15_type_distribution", "SELECT CASE event_type WHEN 'click' THEN 'Scan' WHEN 'view' THEN 'Look-up' WHEN 'purchase' THEN 'Pick' WHEN 'signup' THEN 'Shift start' ELSE 'Other' END AS label, count(*) AS n FROM events GROUP BY 1")
def x15(spark, d):
    return value_counts(view(spark, d, "warehouse_operation").select(map_code(F.col("operation_type"), LABELS, "Other").alias("label")), "label")


@query("x16_mark_usage", "SELECT mark_code, count(DISTINCT item_id) AS items, CAST(sum(usage_count) AS BIGINT) AS usage, round(sum(total_picked), 6) AS picked, round(sum(total_picked) / sum(usage_count), 6) AS picked_per_use FROM {marking} GROUP BY mark_code")
def x16(spark, d):
    return x.mark_usage(view(spark, d, "marking"))


@query("x17_anomaly_counts", f"""
SELECT 'unusual_days' AS category, count(*) AS n FROM ({_SERIES}), (SELECT avg(operations) AS m, stddev_samp(operations) AS s FROM ({_SERIES})) WHERE abs((operations - m) / s) > 1.5
UNION ALL SELECT 'wasteful_items', count(DISTINCT item_id) FROM {{picking}} WHERE waste_rate >= 0.095
UNION ALL SELECT 'slow_employees', count(*) FROM ({_HOURS}) WHERE scan_interval > 300""")
def x17(spark, d):
    parts = {"unusual_days": x08(spark, d), "wasteful_items": x12(spark, d), "slow_employees": x01(spark, d).where("scan_interval > 300")}
    out = None
    for name, rows in parts.items():
        one = rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("category"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("t01_top_employees", "SELECT employee_id, CAST(sum(total_operations) AS BIGINT) AS operations FROM {daily} GROUP BY employee_id ORDER BY operations DESC, employee_id LIMIT 10")
def t01(spark, d):
    by = view(spark, d, "daily").groupBy("employee_id").agg(F.sum("total_operations").alias("operations"))
    return x.top_k(by, [F.desc("operations"), "employee_id"], 10)


@query("z01_error_streaks", """
SELECT employee_id, CAST(max(n) AS BIGINT) AS longest, count_if(n > 5) AS over_five FROM (
  SELECT employee_id, isle, count(*) AS n FROM (
    SELECT *, row_number() OVER w - sum(CASE WHEN operation_type = 'error' THEN 1 ELSE 0 END) OVER w AS isle FROM {warehouse_operation}
    WINDOW w AS (PARTITION BY employee_id ORDER BY start_time, operation_id)) WHERE operation_type = 'error' GROUP BY employee_id, isle) GROUP BY employee_id""")
def z01(spark, d):
    return x.streaks(view(spark, d, "warehouse_operation"), "error")


@query("z02_scan_gaps", """
SELECT employee_id, round(avg(CASE WHEN gap < 2 THEN 1.0 ELSE 0.0 END), 6) AS share_fast, round(min(gap), 6) AS min_gap, round(median(gap), 6) AS median_gap, round(avg(gap), 6) AS mean_gap
FROM (SELECT employee_id, epoch_us(start_time) / 1e6 - lag(epoch_us(start_time) / 1e6) OVER (PARTITION BY employee_id ORDER BY start_time, operation_id) AS gap FROM {warehouse_operation}) WHERE gap IS NOT NULL GROUP BY employee_id""")
def z02(spark, d):
    return x.scan_gaps(view(spark, d, "warehouse_operation"))


@query("z03_competitor_growth", """
SELECT month, codes, lag(codes) OVER (ORDER BY month) AS previous, coalesce(codes > 1.3 * lag(codes) OVER (ORDER BY month), false) AS growing
FROM (SELECT CAST(date_trunc('month', mark_date) AS DATE) AS month, count(*) AS codes FROM {serial_mark} WHERE competitor GROUP BY 1)""")
def z03(spark, d):
    return x.growth(view(spark, d, "serial_mark"), 0.3)


@query("z05_unknown_containers", "SELECT DISTINCT item_id FROM {picking_operation} WHERE item_id NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 10 <> 3)")
def z05(spark, d):
    master = view(spark, d, "part").where("p_partkey % 10 <> 3").select(F.col("p_partkey").alias("item_id"))
    return view(spark, d, "picking_operation").select("item_id").distinct().join(master, "item_id", "left_anti")


@query("z06_own_history", """
SELECT employee_id, operation_date, operations, round(operations - avg(operations) OVER (PARTITION BY employee_id ORDER BY operation_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 6) AS deviation
FROM (SELECT employee_id, operation_date, CAST(sum(total_operations) AS BIGINT) AS operations FROM {daily} GROUP BY ALL)""")
def z06(spark, d):
    return x.own_history(view(spark, d, "daily"))
