"""Queries of lineage to its ends, chunks against the target, concurrent operations, and values at a rank."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.columns import r6
from millrace.operators import lineage, monitoring, selection, sweep
from millrace.plans.registry import query
from millrace.sources.adapters import view

# orders stand for tables: each is made from the one of a third of its number, and neighbours refer to each other (cycles)
_EDGES = """SELECT o_orderkey AS src, o_orderkey // 3 AS dst FROM orders UNION ALL SELECT o_orderkey, o_orderkey + 1 FROM orders WHERE o_orderkey % 3 = 1 UNION ALL SELECT o_orderkey, o_orderkey - 1 FROM orders WHERE o_orderkey % 3 = 2"""
_PATHS = f"""WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM ({_EDGES}) WHERE src <> dst),
walk AS (SELECT src, dst, 1 AS depth FROM e UNION SELECT w.src, e.dst, depth + 1 FROM walk w JOIN e ON w.dst = e.src WHERE w.src <> e.dst AND depth < 40),
p AS (SELECT src, dst, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY src, dst)
"""


def _paths(spark, d):
    k = F.col("o_orderkey")
    to = F.filter(F.array(F.floor(k / 3).cast("long"), F.when(k % 3 == 1, k + 1), F.when(k % 3 == 2, k - 1)), lambda x: x.isNotNull())
    return lineage.closure(view(spark, d, "orders").select(k.alias("src"), F.explode(to).alias("dst")))


@query("l01_closure", _PATHS + "SELECT * FROM p")
def l01_closure(spark, d):
    return _paths(spark, d)


@query("l01_line_summary", _PATHS + "SELECT node, count_if(NOT down) AS upstream, count_if(down) AS downstream, coalesce(max(depth) FILTER (NOT down), 0) AS farthest_up, coalesce(max(depth) FILTER (down), 0) AS farthest_down FROM (SELECT src AS node, true AS down, depth FROM p UNION ALL SELECT dst, false, depth FROM p) GROUP BY node")
def l01_summary(spark, d):
    return lineage.line_summary(_paths(spark, d))


@query("l01_table_history", """
WITH r AS (SELECT l_suppkey AS source, l_partkey AS target, l_returnflag AS operation, l_orderkey AS run_id, l_quantity AS rows_affected, l_shipdate AS at FROM lineitem)
SELECT *, source AS node, CASE WHEN source = target THEN 'both' ELSE 'source' END AS role FROM r UNION ALL SELECT *, target, 'target' FROM r WHERE source <> target""")
def l01_history(spark, d):
    names = {"source": "l_suppkey", "target": "l_partkey", "operation": "l_returnflag", "run_id": "l_orderkey", "rows_affected": "l_quantity", "at": "l_shipdate"}
    return lineage.table_history(view(spark, d, "lineitem").select(*[F.col(c).alias(n) for n, c in names.items()]))


# a chunk per customer, of very different widths; the target is the orders; the history reports what a rule says
_CHUNKS = """SELECT c_custkey AS chunk_no, (c_custkey * c_custkey) // 40 AS range_start, ((c_custkey + 1) * (c_custkey + 1)) // 40 + CASE WHEN c_custkey % 10 = 0 THEN 500 ELSE 0 END AS range_end,
    CASE WHEN c_custkey % 13 = 5 THEN 'failed' ELSE 'completed' END AS status, c_custkey % 7 AS k FROM customer"""
_READ = "CASE WHEN k = 0 THEN 0 WHEN k = 1 THEN range_end - range_start + 1 ELSE range_end - range_start END"


@query("q10_chunks_in_target", f"""
WITH c AS (SELECT *, {_READ} AS rows_read FROM ({_CHUNKS})), d AS (SELECT *, rows_read - CASE WHEN k = 3 THEN 2 ELSE 0 END AS rows_inserted, CASE WHEN k = 2 THEN 1 ELSE 0 END AS rows_conflicted FROM c WHERE status = 'completed'),
t AS (SELECT d.*, coalesce(b.r, 0) - coalesce(a.r, 0) AS found FROM d
  ASOF LEFT JOIN (SELECT o_orderkey AS k0, sum(count(*)) OVER (ORDER BY o_orderkey) AS r FROM orders GROUP BY o_orderkey) b ON b.k0 < d.range_end
  ASOF LEFT JOIN (SELECT o_orderkey AS k0, sum(count(*)) OVER (ORDER BY o_orderkey) AS r FROM orders GROUP BY o_orderkey) a ON a.k0 < d.range_start)
SELECT chunk_no, rows_read, range_end - range_start AS expected_rows, CAST(greatest(found, 0) AS BIGINT) AS rows_in_target,
  CASE WHEN rows_read = 0 THEN 'EMPTY' WHEN rows_read <> range_end - range_start THEN 'READ_COUNT_MISMATCH' WHEN rows_inserted + rows_conflicted <> rows_read THEN 'METRICS_MISMATCH' WHEN greatest(found, 0) <> range_end - range_start THEN 'TARGET_COUNT_MISMATCH' ELSE 'OK' END AS validation FROM t""")
def q10_target(spark, d):
    c, k = F.col("c_custkey"), F.col("c_custkey") % 7
    end = F.expr("(c_custkey + 1) * (c_custkey + 1) div 40") + F.when(c % 10 == 0, 500).otherwise(0)
    chunks = view(spark, d, "customer").select(c.alias("chunk_no"), F.expr("c_custkey * c_custkey div 40").alias("range_start"), end.alias("range_end"), F.when(c % 13 == 5, "failed").otherwise("completed").alias("status"), k.alias("k"))
    width = F.col("range_end") - F.col("range_start")
    chunks = chunks.withColumn("rows_read", F.when(F.col("k") == 0, 0).when(F.col("k") == 1, width + 1).otherwise(width)).withColumns({"rows_inserted": F.col("rows_read") - F.when(F.col("k") == 3, 2).otherwise(0), "rows_conflicted": F.when(F.col("k") == 2, 1).otherwise(0)})
    return monitoring.validate_chunks_in_target(chunks, view(spark, d, "orders"), "o_orderkey").select("chunk_no", "rows_read", "expected_rows", "rows_in_target", "validation")


_SPANS = "SELECT event_id, ts AS s, ts + to_microseconds(CAST(round(value * 60000000) AS BIGINT)) AS e FROM events"
_LEVELS = f"""WITH v AS ({_SPANS}), m AS (SELECT moment, sum(x) AS started, sum(y) AS ended FROM (SELECT s AS moment, 1 AS x, 0 AS y FROM v WHERE s < e UNION ALL SELECT e, 0, 1 FROM v WHERE s < e) GROUP BY moment),
l AS (SELECT moment, started, ended, sum(started - ended) OVER (ORDER BY moment) AS open FROM m)
"""


def _spans(spark, d):
    """Operations that last as many minutes as the event's value."""
    end = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.round(F.col("value") * 60_000_000).cast("long"))
    return view(spark, d, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("s"), end.cast("timestamp_ntz").alias("e"))


@query("m22_open_levels", _LEVELS + "SELECT moment, CAST(started AS BIGINT) AS started, CAST(ended AS BIGINT) AS ended, CAST(open AS BIGINT) AS open FROM l")
def m22_levels(spark, d):
    return sweep.open_levels(_spans(spark, d), "s", "e")


@query("m22_peaks_by_day", _LEVELS + """, n AS (SELECT *, CAST(moment AS DATE) AS day, lag(open) OVER (ORDER BY moment) AS was FROM l)
SELECT day, CAST(max(greatest(open, CASE WHEN moment > CAST(day AS TIMESTAMP) AND first THEN coalesce(was, 0) ELSE 0 END)) AS BIGINT) AS most_open FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY moment) = 1 AS first FROM n) GROUP BY day""")
def m22_peaks(spark, d):
    return sweep.peaks_by_day(sweep.open_levels(_spans(spark, d), "s", "e"))


@query("m22_long_running", f"SELECT event_id, round(epoch(e - s), 6) AS seconds FROM ({_SPANS}) WHERE epoch(e - s) > 6000")
def m22_long(spark, d):
    return sweep.long_running(_spans(spark, d), "s", "e", 6000, F.lit(None).cast("timestamp_ntz")).select("event_id", r6("seconds").alias("seconds"))


_AT = "SELECT {k}, value FROM (SELECT {k}, {x} AS value, row_number() OVER (PARTITION BY {k} ORDER BY {x}) AS r, count(*) OVER (PARTITION BY {k}) AS n FROM {t} WHERE {x} IS NOT NULL) WHERE r = least(floor(n * 0.95), n - 1) + 1"


@query("a19_selected_p95", _AT.format(k="l_returnflag", x="l_extendedprice", t="lineitem"))
def a19_selected(spark, d):
    return selection.value_at(view(spark, d, "lineitem"), "l_extendedprice", 0.95, ["l_returnflag"])


@query("m18_batch_metrics", f"""
SELECT c.run_id, count(*) AS batches, round(avg(seconds), 6) AS avg_seconds, round(CASE WHEN sum(seconds) > 0 THEN sum(rows_read) / sum(seconds) ELSE 0 END, 6) AS rows_per_second, any_value(p.value) AS p95_seconds
FROM {{load_chunk}} c JOIN ({_AT.format(k="run_id", x="seconds", t="{load_chunk}")}) p ON p.run_id = c.run_id WHERE seconds IS NOT NULL GROUP BY c.run_id""")
def m18_metrics(spark, d):
    return monitoring.batch_metrics(view(spark, d, "load_chunk"))
