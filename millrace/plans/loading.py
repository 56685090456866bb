"""Queries of scans, ranges and catalogues."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import columns as c
from millrace.operators import cleaning, features, loading, marts, merging, quality
from millrace.plans.registry import query
from millrace.sources.adapters import view

TABLES = ("customer", "orders", "lineitem", "supplier", "part")


@query("s01_scan", "SELECT l_orderkey AS L_ORDERKEY, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01'")
def s01(spark, d):
    return loading.scan(spark, f"{d}/lineitem.parquet", ["L_ORDERKEY", "l_quantity"], "l_shipdate >= timestamp_ntz'1997-01-01'")


@query("s02_key_ranges", """
SELECT CAST(r AS INTEGER) AS range_no, CAST(a - 1 + r * w AS BIGINT) AS lo, CAST(least(a - 1 + (r + 1) * w, b) AS BIGINT) AS hi
FROM (SELECT min(o_orderkey) AS a, max(o_orderkey) AS b, greatest(1, ceil((max(o_orderkey) - min(o_orderkey) + 1) / 7)) AS w FROM orders), (SELECT unnest(range(0, 7)) AS r) WHERE a - 1 + r * w < least(a - 1 + (r + 1) * w, b)""")
def s02(spark, d):
    r = loading.key_ranges(view(spark, d, "orders"), "o_orderkey", 7)
    return r.select("range_no", F.col("lo").cast("long").alias("lo"), F.col("hi").cast("long").alias("hi"))


@query("s03_time_ranges", "SELECT lo, lo + INTERVAL 1 DAY AS hi FROM (SELECT unnest(generate_series(date_trunc('day', min(ts)), max(ts), INTERVAL 1 DAY)) AS lo FROM events)")
def s03(spark, d):
    return loading.time_ranges(view(spark, d, "events"), "ts", "1 day")


@query("s05_text_key_range", "SELECT o_orderkey FROM orders WHERE lpad(CAST(o_orderkey AS VARCHAR), 10, '0') > '0000001000' AND lpad(CAST(o_orderkey AS VARCHAR), 10, '0') <= '0000009000'")
def s05(spark, d):
    key = F.lpad(F.col("o_orderkey").cast("string"), 10, "0")
    return view(spark, d, "orders").where((key > "0000001000") & (key <= "0000009000")).select("o_orderkey")


@query("s06_page_after_key", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 1000")
def s06(spark, d):
    return features.top_k(view(spark, d, "orders").where("o_orderkey > 500").select("o_orderkey", "o_custkey"), ["o_orderkey"], 1000)


@query("p02_since", "SELECT picking_route_id, item_id FROM {picking_operation} WHERE operation_date >= TIMESTAMP '1998-01-01'")
def p02(spark, d):
    return view(spark, d, "picking_operation").where("operation_date >= timestamp_ntz'1998-01-01'").select("picking_route_id", "item_id")


@query("p03_in_list", "SELECT issue_key FROM {issue} WHERE lower(priority) IN ('1-urgent', '2-high') AND status NOT IN ('F')")
def p03(spark, d):
    return view(spark, d, "issue").where(F.lower("priority").isin("1-urgent", "2-high") & ~F.col("status").isin("F")).select("issue_key")


@query("p08_contains_any", "SELECT doc_id FROM documents WHERE contains(lower(text), 'licensed') OR contains(lower(text), 'copyright')")
def p08(spark, d):
    low = F.lower("text")
    return view(spark, d, "documents").where(low.contains("licensed") | low.contains("copyright")).select("doc_id")


@query("p09_is_distinct", "SELECT t.sales_id FROM {old_sales} t JOIN {new_sales} b ON t.sales_id = b.sales_id WHERE t.status IS DISTINCT FROM b.status OR t.priority IS DISTINCT FROM b.priority")
def p09(spark, d):
    b = view(spark, d, "new_sales").select("sales_id", F.col("status").alias("s2"), F.col("priority").alias("p2"))
    return view(spark, d, "old_sales").join(b, "sales_id").where(c.is_distinct(["status", "priority"], ["s2", "p2"])).select("sales_id")


@query("t03_sort_by_rank", "SELECT o_orderkey, o_orderpriority FROM orders ORDER BY CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 1 WHEN '2' THEN 2 ELSE 3 END, o_orderdate DESC, o_orderkey LIMIT 50")
def t03(spark, d):
    first = F.substring("o_orderpriority", 1, 1)
    rank = F.when(first == "1", 1).when(first == "2", 2).otherwise(3)
    return features.top_k(view(spark, d, "orders"), [rank, F.desc("o_orderdate"), "o_orderkey"], 50).select("o_orderkey", "o_orderpriority")


@query("d01_catalog", None)
def d01(spark, d):
    return quality.catalog({t: view(spark, d, t) for t in TABLES})


@query("d02_drift", """
SELECT 'type_changed' AS drift_type, (SELECT 'extra') AS added, 'o_orderpriority' AS removed, 'o_custkey' AS type_changes FROM (SELECT count(*) FROM orders)""")
def d02(spark, d):
    old = view(spark, d, "orders")
    new = old.select("o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"), "o_orderstatus", "o_totalprice", "o_orderdate", F.lit(1).alias("extra"))
    cat = quality.catalog({"old": old, "new": new})
    return quality.detect_drift(cat.where("table_name = 'old'"), cat.where("table_name = 'new'"))


@query("d04_key_like_columns", "SELECT table_name, column_name FROM information_schema.columns WHERE table_name IN ('customer', 'orders', 'lineitem', 'supplier', 'part') AND regexp_matches(lower(column_name), '(id|key)$')")
def d04(spark, d):
    return quality.key_like_columns(d01(spark, d))


@query("j10_shared_columns", "SELECT a.table_name AS table_a, b.table_name AS table_b, a.column_name FROM information_schema.columns a JOIN information_schema.columns b ON a.column_name = b.column_name AND a.table_name < b.table_name WHERE a.table_name IN ('documents', 'labels', 'benchmark', 'conversations') AND b.table_name IN ('documents', 'labels', 'benchmark', 'conversations')")
def j10(spark, d):
    return quality.shared_columns(quality.catalog({t: view(spark, d, t) for t in ("documents", "labels", "benchmark", "conversations")}))


@query("j01_picking_with_buffer", "SELECT l_orderkey, l_partkey, p_name FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND p_partkey % 3 = 0")
def j01(spark, d):
    p = view(spark, d, "part").where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return view(spark, d, "lineitem").join(p, "l_partkey", "left").select("l_orderkey", "l_partkey", "p_name")


@query("n22_select_ci", "SELECT o_orderkey AS O_OrderKey FROM orders")
def n22(spark, d):
    return cleaning.select_ci(view(spark, d, "orders"), ["O_OrderKey", "no_such"])


@query("u05_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def u05(spark, d):
    return view(spark, d, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query("w07_zscore", "SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS z FROM orders, (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s FROM orders) WHERE abs((o_totalprice - m) / s) > 2")
def w07(spark, d):
    return features.zscore(view(spark, d, "orders"), "o_totalprice", 2.0).select("o_orderkey", c.r6("z").alias("z"))


@query("m22_concurrency", "SELECT date_trunc('hour', ts) AS at, count(*) AS n FROM events GROUP BY 1")
def m22(spark, d):
    return marts.value_counts(view(spark, d, "events").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("at")), "at")


@query("i03_pending_tables", "SELECT user_id, max(ts) AS last_loaded FROM events GROUP BY user_id HAVING max(ts) < TIMESTAMP '2024-01-29 12:00:00'")
def i03(spark, d):
    state = view(spark, d, "events").groupBy("user_id").agg(F.max("ts").alias("last_loaded"))
    return loading.pending_tables(state, "2024-01-30 12:00:00", 24)


@query("u02_union_counts", "SELECT 'customer' AS tbl, count(*) AS rows FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier")
def u02(spark, d):
    return marts.row_counts({t: view(spark, d, t) for t in ("customer", "supplier")})


@query("g06_stamped_upsert", "SELECT count(*) AS rows, count_if(x = 'inserted') AS stamped FROM (SELECT CASE WHEN t.sales_id IS NULL THEN 'inserted' END AS x FROM {old_sales} t FULL OUTER JOIN {new_sales} b ON t.sales_id = b.sales_id)")
def g06(spark, d):
    out = merging.upsert(view(spark, d, "old_sales"), view(spark, d, "new_sales"), ["sales_id"]).withColumn("loaded_at", F.when(F.col("_change") == "inserted", F.current_timestamp()))
    return out.agg(F.count("*").alias("rows"), F.count("loaded_at").alias("stamped"))
