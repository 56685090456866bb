"""Queries of merges, set operations and incremental filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import merging as g
from millrace.plans.registry import query
from millrace.sources.adapters import view

_BOTH = "{old_sales} t FULL OUTER JOIN {new_sales} b ON t.sales_id = b.sales_id"
_COLS = ("sales_id", "customer", "priority", "status")


def _merged(change: str) -> str:
    take = f"({change}) IN ('inserted', 'updated')"
    return "SELECT " + ", ".join(f"CASE WHEN {take} THEN b.{c} ELSE t.{c} END AS {c}" for c in _COLS) + f', {change} AS "_change" FROM {_BOTH}'


_NOTHING = "CASE WHEN b.sales_id IS NULL THEN 'kept' WHEN t.sales_id IS NULL THEN 'inserted' ELSE 'conflicted' END"
_DIFF = "CASE WHEN b.sales_id IS NULL THEN 'kept' WHEN t.sales_id IS NULL THEN 'inserted' WHEN {0} THEN 'updated' ELSE 'unchanged' END"
_ALL = _DIFF.format("t.customer IS DISTINCT FROM b.customer OR t.priority IS DISTINCT FROM b.priority OR t.status IS DISTINCT FROM b.status")


def _frames(spark, d):
    return view(spark, d, "old_sales"), view(spark, d, "new_sales")


@query("g01_insert_ignore", _merged(_NOTHING))
def g01(spark, d):
    return g.upsert(*_frames(spark, d), ["sales_id"], action="nothing")


@query("g02_upsert_if_changed", _merged(_ALL))
def g02(spark, d):
    return g.upsert(*_frames(spark, d), ["sales_id"])


@query("g02_upsert_counts", f"SELECT count_if(x = 'inserted') AS inserted, count_if(x = 'updated') AS updated, count_if(x = 'unchanged') AS unchanged, count_if(x = 'conflicted') AS conflicted FROM (SELECT {_ALL} AS x FROM {_BOTH})")
def g02c(spark, d):
    return g.changes(g02(spark, d))


@query("g03_upsert_always", _merged(_DIFF.format("true")))
def g03(spark, d):
    return g.upsert(*_frames(spark, d), ["sales_id"], compare=[])


@query("g04_upsert_by_subset", _merged(_DIFF.format("t.status IS DISTINCT FROM b.status")))
def g04(spark, d):
    return g.upsert(*_frames(spark, d), ["sales_id"], compare=["status"])


@query("g05_composite_key", """
SELECT l_orderkey AS purchase_id, l_suppkey AS vendor, max(l_quantity) AS qty, 'inserted' AS "_change" FROM lineitem GROUP BY ALL""")
def g05(spark, d):
    rows = view(spark, d, "lineitem").select(F.col("l_orderkey").alias("purchase_id"), F.col("l_suppkey").alias("vendor"), F.col("l_quantity").alias("qty"))
    return g.upsert(rows.limit(0), rows, ["purchase_id", "vendor"])


@query("g07_accumulate", "SELECT user_id, count(*) AS rows_loaded FROM events GROUP BY user_id")
def g07(spark, d):
    e = view(spark, d, "events")
    half = lambda n: e.where(F.col("event_id") % 2 == n).groupBy("user_id").agg(F.count("*").alias("rows_loaded"))
    return g.accumulate(half(0), half(1), "user_id", ["rows_loaded"])


@query("u01_key_diff", """
(SELECT sales_id, 'missing' AS side FROM {old_sales} EXCEPT SELECT sales_id, 'missing' FROM {new_sales})
UNION ALL (SELECT sales_id, 'extra' AS side FROM {new_sales} EXCEPT SELECT sales_id, 'extra' FROM {old_sales})""")
def u01(spark, d):
    return g.key_diff(*_frames(spark, d), ["sales_id"])


@query("u03_merge_last_wins", "SELECT * FROM {new_sales} UNION ALL SELECT * FROM {old_sales} WHERE sales_id NOT IN (SELECT sales_id FROM {new_sales})")
def u03(spark, d):
    return g.merge_wins(list(_frames(spark, d)), ["sales_id"])


@query("u04_merge_first_wins", "SELECT * FROM {old_sales} UNION ALL SELECT * FROM {new_sales} WHERE sales_id NOT IN (SELECT sales_id FROM {old_sales})")
def u04(spark, d):
    return g.merge_wins(list(_frames(spark, d)), ["sales_id"], last=False)


@query("w04_dedupe_first", "SELECT l_orderkey, l_linenumber, min(l_extendedprice) AS price FROM lineitem GROUP BY l_orderkey, l_linenumber")
def w04(spark, d):
    rows = view(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"))
    return g.dedupe_first(rows, ["l_orderkey", "l_linenumber"], ["price"])


@query("w05_latest_per_group", "SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, max((ts, event_id))[1] AS ts FROM events GROUP BY user_id")
def w05(spark, d):
    return g.dedupe_first(view(spark, d, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "ts")


@query("i01_changed_since", "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'")
def i01(spark, d):
    return g.changed_since(view(spark, d, "events"), "ts", "2024-01-20 00:00:00").select("event_id", "ts")


@query("i02_after_cursor", "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-10 00:00:00' OR (ts = TIMESTAMP '2024-01-10 00:00:00' AND event_id > 100)")
def i02(spark, d):
    return g.after_cursor(view(spark, d, "events"), "ts", "event_id", "2024-01-10 00:00:00", 100).select("event_id", "ts")
