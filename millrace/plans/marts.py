"""Queries of the marts, counts and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import marts as m
from millrace.operators.profile import column_profile
from millrace.plans.registry import query
from millrace.sources.adapters import view


@query("a01_serial_mark_stats", """
SELECT item_id, mark_code, count(*) AS total_serials, count_if(accepted) AS accepted_count, count_if(blocked) AS blocked_count,
       count_if(is_defect) AS defect_count, min(mark_date) AS first_mark_date, max(mark_date) AS last_mark_date
FROM {serial_mark} WHERE item_id IS NOT NULL GROUP BY item_id, mark_code""")
def a01(spark, d):
    return m.serial_mark_stats(view(spark, d, "serial_mark"))


@query("a02_picking_route_summary", """
SELECT r.picking_route_id, r.employee_id, r.employee_name, count(t.task_id) AS total_tasks,
       round(coalesce(sum(t.picked_qty), 0), 6) AS total_picked, round(coalesce(sum(t.waste_qty), 0), 6) AS total_waste,
       CAST(epoch(r.end_date - r.start_date) AS DOUBLE) AS route_duration, r.start_date, r.end_date
FROM {picking_route} r LEFT JOIN {pack_task} t ON r.picking_route_id = t.picking_route_id
GROUP BY ALL""")
def a02(spark, d):
    return m.picking_route_summary(view(spark, d, "picking_route"), view(spark, d, "pack_task"))


@query("a03_order_trans_stats", """
SELECT order_id, count(*) AS total_items, round(sum(qty), 6) AS total_qty, round(sum(picked_qty), 6) AS total_picked,
       round(sum(waste_qty), 6) AS total_waste, min(created_datetime) AS first_trans_date, max(created_datetime) AS last_trans_date
FROM {order_trans} WHERE order_id IS NOT NULL GROUP BY order_id""")
def a03(spark, d):
    return m.order_trans_stats(view(spark, d, "order_trans"))


@query("a04_sales_summary", """
SELECT customer_account, count(DISTINCT sales_id) AS total_orders, count(*) AS total_sales, min(invoice_date) AS first_order_date,
       max(invoice_date) AS last_order_date, string_agg(DISTINCT currency_code, ', ' ORDER BY currency_code) AS currencies_used
FROM {sales_order} WHERE customer_account IS NOT NULL GROUP BY customer_account""")
def a04(spark, d):
    return m.sales_summary(view(spark, d, "sales_order"))


@query("a05_purchase_summary", """
SELECT vendor_account, count(DISTINCT purchase_id) AS total_orders, count(*) AS total_purchases, min(order_date) AS first_order_date,
       max(order_date) AS last_order_date, string_agg(DISTINCT currency_code, ', ' ORDER BY currency_code) AS currencies_used
FROM {purchase_order} WHERE vendor_account IS NOT NULL GROUP BY vendor_account""")
def a05(spark, d):
    return m.purchase_summary(view(spark, d, "purchase_order"))


@query("a06_pack_task_stats", """
SELECT picking_route_id, count(*) AS total_tasks, round(sum(qty), 6) AS total_qty, round(sum(picked_qty), 6) AS total_picked,
       round(sum(waste_qty), 6) AS total_waste, round(avg(qty), 6) AS avg_qty_per_task
FROM {pack_task} WHERE picking_route_id IS NOT NULL GROUP BY picking_route_id""")
def a06(spark, d):
    return m.pack_task_stats(view(spark, d, "pack_task"))


@query("a07_daily_operations", """
SELECT CAST(ts AS DATE) AS operation_date, CAST(user_id AS VARCHAR) AS employee_id, 'Employee ' || user_id AS employee_name,
       event_type AS operation_type, count(*) AS total_operations, round(sum(value), 6) AS total_duration, round(avg(value), 6) AS avg_duration
FROM events GROUP BY ALL""")
def a07(spark, d):
    out = m.daily_operations(view(spark, d, "warehouse_operation"))
    return out.withColumns({c: m.r6(c) for c in ("total_duration", "avg_duration")})


@query("a08_picking_efficiency", """
SELECT l_orderkey AS picking_route_id, l_partkey AS item_id, round(sum(l_quantity), 6) AS total_picked,
       round(sum(l_quantity * l_discount), 6) AS total_waste, count(*) AS operation_count,
       round(CASE WHEN sum(l_quantity) > 0 THEN sum(l_quantity * l_discount) / sum(l_quantity) ELSE 0 END, 6) AS waste_rate
FROM lineitem GROUP BY l_orderkey, l_partkey""")
def a08(spark, d):
    out = m.picking_efficiency(view(spark, d, "picking_operation"))
    return out.withColumns({c: m.r6(c) for c in ("total_picked", "total_waste", "waste_rate")})


@query("a09_marking_statistics", """
SELECT l_returnflag || l_linestatus AS mark_code, l_partkey AS item_id, count(*) AS usage_count, round(sum(l_quantity), 6) AS total_picked
FROM lineitem GROUP BY ALL""")
def a09(spark, d):
    return m.marking_statistics(view(spark, d, "picking_operation")).withColumn("total_picked", m.r6("total_picked"))


_CODES = "count(*) AS total_codes, count_if(competitor) AS competitor_count, count_if(blocked) AS blocked_count, min(mark_date) AS first_date, max(mark_date) AS last_date FROM {serial_mark}"


@query("a10_marking_codes_by_item", f"SELECT item_id, {_CODES} GROUP BY item_id")
def a10(spark, d):
    return m.marking_codes(view(spark, d, "serial_mark"), "item")


@query("a11_marking_codes_by_day", f"SELECT CAST(mark_date AS DATE) AS mark_day, {_CODES} GROUP BY CAST(mark_date AS DATE)")
def a11(spark, d):
    return m.marking_codes(view(spark, d, "serial_mark"), "day")


@query("a12_diff_act_by_type", "SELECT l_returnflag AS act_type, count(*) AS total, min(l_shipdate) AS first_date, max(l_shipdate) AS last_date FROM lineitem GROUP BY l_returnflag")
def a12(spark, d):
    return m.count_with_span(view(spark, d, "picking_operation"), "act_type", "operation_date")


@query("a13_journal_by_day", """
SELECT CAST(user_id AS VARCHAR) AS employee_id, CAST(ts AS DATE) AS operation_date, count(*) AS operations,
       round(sum(value), 6) AS total_qty, round(avg(value), 6) AS avg_duration FROM events GROUP BY ALL""")
def a13(spark, d):
    return m.journal_by_day(view(spark, d, "warehouse_operation"))


@query("a14_routes_by_status", "SELECT o_orderstatus AS status, count(*) AS total, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date FROM orders GROUP BY o_orderstatus")
def a14(spark, d):
    return m.count_with_span(view(spark, d, "picking_route"), "status", "start_date")


@query("a15_mart_row_counts", """
SELECT 'order_trans_stats' AS tbl, count(DISTINCT l_orderkey) AS rows FROM lineitem
UNION ALL SELECT 'pack_task_stats', count(DISTINCT l_orderkey) FROM lineitem
UNION ALL SELECT 'sales_summary', count(DISTINCT o_custkey) FROM orders
UNION ALL SELECT 'purchase_summary', count(DISTINCT l_suppkey) FROM lineitem""")
def a15(spark, d):
    v = lambda n: view(spark, d, n)
    return m.row_counts({"order_trans_stats": m.order_trans_stats(v("order_trans")), "pack_task_stats": m.pack_task_stats(v("pack_task")), "sales_summary": m.sales_summary(v("sales_order")), "purchase_summary": m.purchase_summary(v("purchase_order"))})


@query("a16_source_target_counts", """
SELECT 'orders' AS tbl, (SELECT count(*) FROM orders) AS source_rows, (SELECT count(*) FROM {old_sales}) AS target_rows
UNION ALL SELECT 'lineitem', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM {pack_task})""")
def a16(spark, d):
    v = lambda n: view(spark, d, n)
    source, target = m.row_counts({"orders": v("orders"), "lineitem": v("lineitem")}), m.row_counts({"orders": v("old_sales"), "lineitem": v("pack_task")})
    return source.withColumnRenamed("rows", "source_rows").join(target.withColumnRenamed("rows", "target_rows"), "tbl")


@query("a22_profile_columns", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count(*) AS total, count(nullif(trim({c}), '')) AS non_blank, count(DISTINCT nullif(trim({c}), '')) AS distinct_values,
    round(CASE WHEN count(*) > 0 THEN 100.0 * (count(*) - count(nullif(trim({c}), ''))) / count(*) ELSE 0 END, 6) AS null_pct,
    CASE WHEN 100.0 * (count(*) - count(nullif(trim({c}), ''))) / count(*) > 95 OR count(DISTINCT nullif(trim({c}), '')) <= 1 THEN 'empty' ELSE 'keep' END AS decision
    FROM {{raw_sales}}""" for c in ("recid", "custaccount", "deliverydate", "dataareaid")))  # fmt: skip
def a22(spark, d):
    return m.profile_columns(view(spark, d, "raw_sales"), ["recid", "custaccount", "deliverydate", "dataareaid"])


_RAW_SALES = ("recid", "salesid", "custaccount", "deliverydate", "amount", "currencycode", "salesstatus", "modifieddatetime", "dataareaid")


@query("a22_column_samples", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", (SELECT count(*) FROM {{raw_sales}}) AS total, count(v) AS non_blank, CASE WHEN count(DISTINCT v) < 1024 THEN count(DISTINCT v) END AS few_values,
    (SELECT string_agg(v, '|' ORDER BY md5(v)) FROM (SELECT DISTINCT nullif(trim({c}), '') AS v FROM {{raw_sales}} WHERE nullif(trim({c}), '') IS NOT NULL ORDER BY md5(v) LIMIT 5)) AS samples,
    CASE WHEN count(v) < 0.05 * (SELECT count(*) FROM {{raw_sales}}) OR count(DISTINCT v) <= 1 THEN 'empty' ELSE 'keep' END AS decision
    FROM (SELECT nullif(trim({c}), '') AS v FROM {{raw_sales}})""" for c in _RAW_SALES))  # fmt: skip
def a22_samples(spark, d):
    found = column_profile(view(spark, d, "raw_sales"), list(_RAW_SALES))
    return found.select("column", "total", "non_blank", F.when(F.col("exact"), F.col("distinct_values")).alias("few_values"), F.array_join("samples", "|").alias("samples"), "decision")


@query("a23_value_counts", "SELECT event_type AS operation_type, count(*) AS n FROM events GROUP BY event_type")
def a23(spark, d):
    return m.value_counts(view(spark, d, "warehouse_operation"), "operation_type")


@query("a24_weekday_by_month", "SELECT weekday, " + ", ".join(f"round(sum(CASE WHEN month = {k} THEN n END), 6) AS month_{k}" for k in range(1, 13)) + """
FROM (SELECT CAST(isodow(l_shipdate) - 1 AS INTEGER) AS weekday, CAST(month(l_shipdate) AS INTEGER) AS month, l_quantity AS n FROM lineitem) GROUP BY weekday""")
def a24(spark, d):
    rows = view(spark, d, "picking_operation").selectExpr("weekday(operation_date) AS weekday", "month(operation_date) AS month", "picked_qty AS n")
    return m.pivot_sum(rows, "weekday", "month", "n", list(range(1, 13)))


@query("a25_describe", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
    round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM lineitem"""
    for c in ("l_quantity", "l_extendedprice")))
def a25(spark, d):
    return m.describe(view(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"])


@query("a26_binary_metrics", """
SELECT tp, fp, fn, tn, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1
FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r
      FROM (SELECT count_if(y AND h) AS tp, count_if(NOT y AND h) AS fp, count_if(y AND NOT h) AS fn, count_if(NOT y AND NOT h) AS tn
            FROM (SELECT l_discount > 0.08 AS y, l_tax > 0.05 AS h FROM lineitem)))""")
def a26(spark, d):
    rows = view(spark, d, "lineitem").selectExpr("CAST(l_discount > 0.08 AS INT) AS y", "CAST(l_tax > 0.05 AS INT) AS h")
    return m.binary_metrics(rows, "y", "h").withColumns({c: m.r6(c) for c in ("precision", "recall", "f1")})
