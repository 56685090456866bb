"""Queries of data quality, reconciliation, schema and lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import quality as q
from millrace.plans.registry import query
from millrace.sources.adapters import view

_KEY = "CASE WHEN regexp_matches(trim(recid), '^[0-9]+$') THEN TRY_CAST(trim(recid) AS BIGINT) END"


@query("q01_quality_checks", """
SELECT 'not_empty' AS name, count(*) > 0 AS passed, CAST(count(*) AS VARCHAR) AS details FROM {raw_sales}
UNION ALL SELECT 'min_rows', count(*) >= 100, CAST(count(*) AS VARCHAR) FROM {raw_sales}
UNION ALL SELECT 'no_duplicates', count(*) = 0, count(*) || '/' || CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM (SELECT count(*) AS c FROM {raw_sales} GROUP BY recid HAVING count(*) > 1)
UNION ALL SELECT 'null_rate_recid', 100.0 * count_if(recid IS NULL) / count(*) <= 0.1, CAST(count_if(recid IS NULL) AS VARCHAR) FROM {raw_sales}""")
def q01(spark, d):
    return q.quality_checks(view(spark, d, "raw_sales"), "recid", ["recid"], 100, 0.1)


@query("q02_check_summary", """
SELECT bool_and(p) AS all_passed, count_if(p) AS passed, count_if(NOT p) AS failed FROM (
  SELECT count(*) > 0 AS p FROM {raw_sales} UNION ALL SELECT count(*) >= 100 FROM {raw_sales}
  UNION ALL SELECT count(*) = 0 FROM (SELECT recid FROM {raw_sales} GROUP BY recid HAVING count(*) > 1)
  UNION ALL SELECT 100.0 * count_if(recid IS NULL) / count(*) <= 0.1 FROM {raw_sales})""")
def q02(spark, d):
    return q.check_summary(q01(spark, d))


@query("q03_key_quality", f"""
SELECT count(*) AS total, count_if(recid IS NULL) AS nulls, count_if(trim(recid) = '') AS blanks,
       count_if(trim(recid) <> '' AND NOT regexp_matches(trim(recid), '^[0-9]+$')) AS non_numeric,
       count_if(regexp_matches(trim(recid), '^[0-9]+$') AND length(trim(recid)) > 19) AS too_long, min({_KEY}) AS min_key, max({_KEY}) AS max_key,
       coalesce(max({_KEY}) > 2147483647, false) AS exceeds_int FROM {{raw_sales}}""")
def q03(spark, d):
    return q.key_quality(view(spark, d, "raw_sales"), "recid")


@query("q04_fixed_width_gate", """
SELECT count_if(recid IS NULL OR trim(recid) = '' OR NOT regexp_matches(recid, '^[0-9]+$')) AS bad_keys, CAST(min(length(recid)) AS INTEGER) AS min_length, CAST(max(length(recid)) AS INTEGER) AS max_length,
       count_if(recid IS NULL OR trim(recid) = '' OR NOT regexp_matches(recid, '^[0-9]+$')) = 0 AND min(length(recid)) = max(length(recid)) AS passed FROM {raw_sales}""")
def q04(spark, d):
    return q.fixed_width_gate(view(spark, d, "raw_sales"), "recid")


@query("q05_castable_gate", """
SELECT 'amount' AS "column", count(nullif(trim(amount), '')) AS filled, count_if(nullif(trim(amount), '') IS NOT NULL AND TRY_CAST(trim(amount) AS DECIMAL(38,10)) IS NULL) AS failing FROM {raw_sales}
UNION ALL SELECT 'deliverydate', count(nullif(trim(deliverydate), '')), count_if(nullif(trim(deliverydate), '') IS NOT NULL AND TRY_CAST(trim(deliverydate) AS TIMESTAMP) IS NULL) FROM {raw_sales}""")
def q05(spark, d):
    return q.castable_gate(view(spark, d, "raw_sales"), {"amount": "decimal(38,10)", "deliverydate": "timestamp_ntz"})


@query("q06_reconcile", """
SELECT (SELECT count(DISTINCT sales_id) FROM {new_sales}) AS raw_distinct, (SELECT count(*) FROM {old_sales}) AS target_rows, 0 AS null_keys, 0 AS duplicate_groups,
       (SELECT count(*) FROM (SELECT sales_id FROM {new_sales} EXCEPT SELECT sales_id FROM {old_sales})) AS missing,
       (SELECT count(*) FROM (SELECT sales_id FROM {old_sales} EXCEPT SELECT sales_id FROM {new_sales})) AS extra, 'REVIEW_REQUIRED' AS verdict""")
def q06(spark, d):
    return q.reconcile(view(spark, d, "new_sales"), view(spark, d, "old_sales"), "sales_id")


@query("q07_validate_target", "SELECT CAST(sum(c) AS BIGINT) AS rows, count_if(c > 1) AS duplicate_groups FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def q07(spark, d):
    return q.validate_target(view(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("q08_key_stats", "SELECT count(*) AS rows, count(DISTINCT o_custkey) AS distinct_keys, min(o_custkey) AS min_key, max(o_custkey) AS max_key, count_if(o_custkey IS NULL) AS null_keys FROM orders")
def q08(spark, d):
    return q.key_stats(view(spark, d, "orders"), "o_custkey")


@query("q09_range_stats", """
SELECT CAST(r AS BIGINT) AS range_no, count(l_partkey) AS rows, count(DISTINCT l_partkey) AS distinct_keys
FROM (SELECT unnest(range(0, (max(l_partkey) - min(l_partkey)) // 37 + 1)) AS r, min(l_partkey) AS lo FROM lineitem)
LEFT JOIN (SELECT l_partkey FROM lineitem WHERE l_partkey % 200 > 80) ON (l_partkey - (SELECT min(l_partkey) FROM lineitem WHERE l_partkey % 200 > 80)) // 37 = r
WHERE r <= (SELECT (max(l_partkey) - min(l_partkey)) // 37 FROM lineitem WHERE l_partkey % 200 > 80) GROUP BY r""")
def q09(spark, d):
    return q.range_stats(view(spark, d, "lineitem").where("l_partkey % 200 > 80"), "l_partkey", 37)


@query("q12_business_key", "SELECT count_if(vendor_account IS NULL OR purchase_id IS NULL) = 0 AS no_blank_parts, (SELECT count(*) FROM (SELECT 1 FROM {purchase_order} GROUP BY vendor_account, purchase_id HAVING count(*) > 1)) = 0 AS no_duplicates FROM {purchase_order}")
def q12(spark, d):
    return q.business_key_ok(view(spark, d, "purchase_order"), ["vendor_account", "purchase_id"])


@query("q14_unparseable_dates", "SELECT salesid, deliverydate FROM {raw_sales} WHERE nullif(trim(deliverydate), '') IS NOT NULL AND TRY_CAST(trim(deliverydate) AS TIMESTAMP) IS NULL ORDER BY salesid LIMIT 100")
def q14(spark, d):
    return q.cast_failures(view(spark, d, "raw_sales"), "deliverydate", "timestamp_ntz", "salesid", 100)


@query("q17_encoding", """SELECT 'text' AS "column", count(text) AS filled, count_if(contains(text, '?')) AS with_question_mark, count_if(regexp_matches(text, '[\u0400-\u04ff]')) AS cyrillic FROM documents""")
def q17(spark, d):
    return q.encoding_stats(view(spark, d, "documents"), ["text"])


@query("q18_count_match", "SELECT (SELECT count(*) FROM {new_sales}) AS source_rows, (SELECT count(*) FROM {old_sales}) AS target_rows, (SELECT count(*) FROM {new_sales}) - (SELECT count(*) FROM {old_sales}) AS diff")
def q18(spark, d):
    a = view(spark, d, "new_sales").agg(F.count("*").alias("source_rows"))
    return a.crossJoin(view(spark, d, "old_sales").agg(F.count("*").alias("target_rows"))).withColumn("diff", F.col("source_rows") - F.col("target_rows"))


@query("j07_rows_in_ranges", "SELECT range_no, count(o_orderkey) AS rows FROM (SELECT unnest(range(0, 20)) AS range_no) LEFT JOIN orders ON o_orderkey >= range_no * 700 AND o_orderkey < range_no * 700 + 650 GROUP BY range_no")
def j07(spark, d):
    ranges = spark.range(20).select(F.col("id").alias("range_no"), (F.col("id") * 700).alias("lo"), (F.col("id") * 700 + 650).alias("hi"))
    return rows_in_ranges(ranges, view(spark, d, "orders"), "o_orderkey", 700)


def rows_in_ranges(ranges, rows, key: str, width: int):
    """Rows per [lo, hi) range: both sides meet in buckets of `width` keys, so the range test joins by equality first."""
    cut = ranges.select("*", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))).alias("_b"))
    kept = rows.select(F.col(key).alias("_k"), F.floor(F.col(key) / width).alias("_b"))
    found = cut.join(kept, "_b").where("_k >= lo and _k < hi").groupBy("range_no").agg(F.count("*").alias("rows"))
    return ranges.select("range_no").join(found, "range_no", "left").na.fill(0)


@query("l01_lineage", """
WITH RECURSIVE e AS (SELECT DISTINCT l_orderkey AS src, l_partkey AS dst FROM lineitem WHERE l_orderkey <> l_partkey),
walk AS (SELECT 1 AS node, 0 AS depth UNION SELECT dst, depth + 1 FROM walk JOIN e ON src = node WHERE depth < 3)
SELECT CAST(1 AS BIGINT) AS root, CAST(node AS BIGINT) AS node, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY node""")
def l01(spark, d):
    edges = view(spark, d, "lineitem").where("l_orderkey <> l_partkey").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst")).distinct()
    return q.closure(edges, spark.range(1).select(F.lit(1).cast("long").alias("root")), 3)
