"""Queries of the refreshed summaries: three change sets each, and the same result as a recomputation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.functions.columns import r6
from millrace.operators.refresh import MaterializedView, Summary, changes
from millrace.plans.registry import query
from millrace.session import shared_dir
from millrace.sources.adapters import view


def _refreshed(spark, summary, load, updated_from, updated_to, removed, added):
    """A view after a first load and three change sets; the second is given twice."""
    kept = MaterializedView(spark, f"{shared_dir(spark)}/view-{uuid.uuid4().hex}", summary)
    kept.refresh("load", changes(None, load))
    kept.refresh("update", changes(updated_from, updated_to))
    kept.refresh("remove", changes(removed, None))
    kept.refresh("update", changes(updated_from, updated_to))
    kept.refresh("add", changes(None, added))
    return kept.read(load)


# Items' lines: those of line number 7 come late, 2 is corrected, returned ones of number 1 are taken back.
_LINES = """SELECT l_partkey AS item_id, l_suppkey + CASE WHEN l_linenumber = 2 THEN 1 ELSE 0 END AS supplier, l_quantity + CASE WHEN l_linenumber = 2 THEN 3 ELSE 0 END AS qty,
    CASE WHEN l_linenumber = 2 THEN l_shipdate + INTERVAL 1 DAY ELSE l_shipdate END AS day FROM lineitem WHERE NOT (l_linenumber = 1 AND l_returnflag = 'R')"""


@query("s15_codes_by_item", f"SELECT item_id, count(*) AS total_codes, round(sum(qty), 6) AS qty, count(DISTINCT supplier) AS suppliers, min(day) AS first_date, max(day) AS last_date FROM ({_LINES}) GROUP BY item_id")
def s15_items(spark, d):
    rows = view(spark, d, "lineitem").select(F.col("l_partkey").alias("item_id"), F.col("l_suppkey").alias("supplier"), F.col("l_quantity").alias("qty"), F.col("l_shipdate").alias("day"), F.col("l_linenumber").alias("n"), F.col("l_returnflag").alias("flag"))
    moved = rows.where("n = 2").withColumns({"supplier": F.col("supplier") + 1, "qty": F.col("qty") + 3, "day": F.expr("day + INTERVAL 1 DAY")})
    summary = Summary(keys=("item_id",), sums=("qty",), distincts=("supplier",), extremes=("day",))
    done = _refreshed(spark, summary, rows.where("n <> 7"), rows.where("n = 2"), moved, rows.where("n = 1 and flag = 'R'"), rows.where("n = 7"))
    return done.select("item_id", F.col("row_count").alias("total_codes"), r6("qty_sum").alias("qty"), F.col("supplier_distinct").alias("suppliers"), F.col("day_min").alias("first_date"), F.col("day_max").alias("last_date"))


_ROUTES = """SELECT CASE WHEN o_orderkey % 5 = 1 THEN 'X' WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS status, o_custkey AS employee, o_orderdate AS day FROM orders WHERE o_orderkey % 5 <> 2"""


@query("s15_routes_by_status", f"SELECT status, count(*) AS total, count(DISTINCT employee) AS employees, min(day) AS first_date, max(day) AS last_date FROM ({_ROUTES}) GROUP BY status")
def s15_routes(spark, d):
    """Routes change their status; one status is none, and a new one appears."""
    status = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus"))
    rows = view(spark, d, "orders").select(status.alias("status"), F.col("o_custkey").alias("employee"), F.col("o_orderdate").alias("day"), (F.col("o_orderkey") % 5).alias("k"))
    summary = Summary(keys=("status",), distincts=("employee",), extremes=("day",))
    done = _refreshed(spark, summary, rows.where("k <> 4"), rows.where("k = 1"), rows.where("k = 1").withColumn("status", F.lit("X")), rows.where("k = 2"), rows.where("k = 4"))
    return done.select("status", F.col("row_count").alias("total"), F.col("employee_distinct").alias("employees"), F.col("day_min").alias("first_date"), F.col("day_max").alias("last_date"))


@query("s15_journal_by_day", """
SELECT user_id AS employee_id, CAST(ts AS DATE) AS operation_date, count(*) AS operations, round(sum(CASE WHEN event_id % 11 = 3 THEN NULL WHEN event_id % 6 = 1 THEN value * 2 ELSE value END), 6) AS total_qty,
    round(avg(CASE WHEN event_id % 11 = 3 THEN NULL WHEN event_id % 6 = 1 THEN value * 2 ELSE value END), 6) AS avg_duration FROM events WHERE event_id % 6 <> 2 GROUP BY ALL""")
def s15_journal(spark, d):
    value = F.when(F.col("event_id") % 11 != 3, F.col("value"))
    rows = view(spark, d, "events").select(F.col("user_id").alias("employee_id"), F.to_date("ts").alias("operation_date"), value.alias("qty"), (F.col("event_id") % 6).alias("k"))
    summary = Summary(keys=("employee_id", "operation_date"), sums=("qty",))
    done = _refreshed(spark, summary, rows.where("k <> 5"), rows.where("k = 1"), rows.where("k = 1").withColumn("qty", F.col("qty") * 2), rows.where("k = 2"), rows.where("k = 5"))
    return done.select("employee_id", "operation_date", F.col("row_count").alias("operations"), r6("qty_sum").alias("total_qty"), r6(F.col("qty_sum") / F.col("qty_n")).alias("avg_duration"))
