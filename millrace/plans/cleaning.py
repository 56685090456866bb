"""Queries of the cleaning expressions and mappings."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import columns as c
from millrace.operators import cleaning as k
from millrace.plans.registry import query
from millrace.sources.adapters import view

_KEY = "CASE WHEN regexp_matches(trim(recid), '^[0-9]+$') THEN TRY_CAST(trim(recid) AS BIGINT) END"
_DAY = "CASE WHEN nullif(trim(deliverydate), '') <> '1900-01-01' THEN TRY_CAST(trim(deliverydate) AS TIMESTAMP) END"


@query("n01_blank_to_null", "SELECT salesid, nullif(trim(custaccount), '') AS customer FROM {raw_sales}")
def n01(spark, d):
    return view(spark, d, "raw_sales").select("salesid", c.clean_text(F.col("custaccount")).alias("customer"))


@query("n02_strict_bigint", "SELECT CAST(trim(recid) AS BIGINT) AS key FROM {raw_sales} WHERE regexp_matches(trim(recid), '^[0-9]{{1,18}}$')".replace("{{", "{").replace("}}", "}"))
def n02(spark, d):
    return view(spark, d, "raw_sales").where(F.btrim("recid").rlike("^[0-9]{1,18}$")).select(c.to_bigint(F.col("recid"), strict=True).alias("key"))


@query("n03_guarded_bigint", f"SELECT salesid, {_KEY} AS key FROM {{raw_sales}}")
def n03(spark, d):
    return view(spark, d, "raw_sales").select("salesid", c.to_bigint(F.col("recid")).alias("key"))


@query("n04_numeric", "SELECT salesid, CAST(TRY_CAST(trim(amount) AS DECIMAL(38,10)) AS DOUBLE) AS amount FROM {raw_sales}")
def n04(spark, d):
    return view(spark, d, "raw_sales").select("salesid", c.to_number(F.col("amount")).cast("double").alias("amount"))


@query("n05_timestamp", "SELECT salesid, TRY_CAST(nullif(trim(deliverydate), '') AS TIMESTAMP) AS delivery FROM {raw_sales}")
def n05(spark, d):
    return view(spark, d, "raw_sales").select("salesid", c.to_ts(F.col("deliverydate")).alias("delivery"))


@query("n07_sentinel_dates", f"SELECT salesid, {_DAY} AS delivery FROM {{raw_sales}}")
def n07(spark, d):
    return view(spark, d, "raw_sales").select("salesid", c.to_ts(F.col("deliverydate"), sentinels=("1900-01-01", "1900-01-01 00:00:00"), guard=True).alias("delivery"))


@query("n10_plain_line", "SELECT doc_id, md5(replace(replace(replace(replace(text, chr(9), ' '), chr(10), ' '), chr(13), ''), chr(0), '')) AS digest FROM documents")
def n10(spark, d):
    return view(spark, d, "documents").select("doc_id", F.md5(c.plain_line(F.col("text"))).alias("digest"))


@query("n11_nonfinite_to_null", "SELECT event_id, CASE WHEN event_id % 5 IN (0, 1) THEN NULL ELSE value END AS value FROM events")
def n11(spark, d):
    x = F.when(F.col("event_id") % 5 == 0, float("nan")).when(F.col("event_id") % 5 == 1, float("inf")).otherwise(F.col("value"))
    return view(spark, d, "events").select("event_id", c.null_nonfinite(x).alias("value"))


@query("n12_decode_bytes", "SELECT doc_id, md5(text) AS digest FROM documents")
def n12(spark, d):
    rows = view(spark, d, "documents").select("doc_id", F.encode("text", "UTF-8").alias("text"))
    return k.decode_bytes(rows, "text", ["utf-8", "cp1252", "cp1251", "latin-1"]).select("doc_id", F.md5("text").alias("digest"))


@query("n13_rejects", f"SELECT reason, count(*) AS n FROM (SELECT CASE WHEN {_KEY} IS NULL THEN 'bad key' WHEN nullif(trim(custaccount), '') IS NULL THEN 'no customer' ELSE 'good' END AS reason FROM {{raw_sales}}) GROUP BY reason")
def n13(spark, d):
    good, bad = k.split_rejects(view(spark, d, "raw_sales"), {"bad key": c.to_bigint(F.col("recid")).isNull(), "no customer": c.clean_text(F.col("custaccount")).isNull()})
    return bad.select("reason").unionByName(good.select(F.lit("good").alias("reason"))).groupBy("reason").agg(F.count("*").alias("n"))


@query("n15_row_ids", "SELECT row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS row_id, l_shipdate, l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem")
def n15(spark, d):
    rows = view(spark, d, "lineitem").select("l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return k.with_row_id(rows, ["l_shipdate", "l_orderkey"])


@query("n16_calendar_parts", "SELECT event_id, CAST(ts AS DATE) AS day, CAST(isodow(ts) - 1 AS INTEGER) AS weekday, dayname(ts) AS day_name, CAST(month(ts) AS INTEGER) AS month FROM events")
def n16(spark, d):
    t = F.col("ts")
    return view(spark, d, "events").select("event_id", F.to_date(t).alias("day"), F.weekday(t).alias("weekday"), F.date_format(t, "EEEE").alias("day_name"), F.month(t).alias("month"))


@query("n18_days_between", "SELECT event_id, CAST(floor((epoch(TIMESTAMP '2024-01-15 12:00:00') - epoch(ts)) / 86400) AS BIGINT) AS days FROM events")
def n18(spark, d):
    return view(spark, d, "events").select("event_id", c.days_between(F.col("ts"), F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")).alias("days"))


@query("n23_schema_sync", "SELECT o_orderkey AS O_ORDERKEY, CAST(NULL AS VARCHAR) AS region, o_orderstatus AS o_orderstatus FROM orders")
def n23(spark, d):
    return k.sync_schema(view(spark, d, "orders"), ["O_ORDERKEY", "region", "o_orderstatus"])


@query("n24_cast_by_type", f"SELECT salesid, TRY_CAST(trim(recid) AS BIGINT) AS recid, CAST(TRY_CAST(trim(amount) AS DECIMAL(38,10)) AS DOUBLE) AS amount FROM {{raw_sales}}")
def n24(spark, d):
    return k.cast_by_map(view(spark, d, "raw_sales").select("salesid", "recid", "amount"), {"recid": "bigint", "amount": "numeric"}).withColumn("amount", F.col("amount").cast("double"))


# Stage mappings: (target, Spark SQL expression).
SALES_ORDER = [
    ("sales_id", "nullif(btrim(salesid), '')"), ("source_recid", "CASE WHEN btrim(recid) RLIKE '^[0-9]+$' THEN try_cast(btrim(recid) AS bigint) END"),
    ("customer_account", "nullif(btrim(custaccount), '')"), ("invoice_date", "CAST(NULL AS timestamp_ntz)"),
    ("delivery_date", "CASE WHEN btrim(deliverydate) NOT IN ('', '1900-01-01', '1900-01-01 00:00:00') THEN try_cast(btrim(deliverydate) AS timestamp_ntz) END"),
    ("currency_code", "nullif(btrim(currencycode), '')"), ("sales_status", "nullif(btrim(salesstatus), '')"),
    ("modified_datetime", "try_cast(nullif(btrim(modifieddatetime), '') AS timestamp_ntz)"), ("data_area_id", "nullif(btrim(dataareaid), '')"),
]


@query("n25f_sales_order", f"""
SELECT nullif(trim(salesid), '') AS sales_id, {_KEY} AS source_recid, nullif(trim(custaccount), '') AS customer_account, CAST(NULL AS TIMESTAMP) AS invoice_date,
       {_DAY} AS delivery_date, nullif(trim(currencycode), '') AS currency_code, salesstatus AS sales_status,
       TRY_CAST(modifieddatetime AS TIMESTAMP) AS modified_datetime, dataareaid AS data_area_id FROM {{raw_sales}}""")
def n25f(spark, d):
    return k.apply_mapping(view(spark, d, "raw_sales"), SALES_ORDER)


@query("n25j_marking_code", "SELECT DISTINCT mark_code, item_id FROM {serial_mark} WHERE mark_code IS NOT NULL")
def n25j(spark, d):
    return view(spark, d, "serial_mark").where("mark_code is not null").select("mark_code", "item_id").distinct()


@query("n25k_picking_with_buffer", """
SELECT p.picking_route_id, p.item_id, p.mark_code, p.picked_qty - p.waste_qty AS diff_qty, s_name AS pallet_id
FROM {picking_operation} p LEFT JOIN supplier ON s_suppkey = p.supplier_id AND s_suppkey % 4 <> 0""")
def n25k(spark, d):
    buffer = view(spark, d, "supplier").where("s_suppkey % 4 <> 0").select(F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("pallet_id"))
    return view(spark, d, "picking_operation").join(buffer, "supplier_id", "left").select("picking_route_id", "item_id", "mark_code", (F.col("picked_qty") - F.col("waste_qty")).alias("diff_qty"), "pallet_id")
