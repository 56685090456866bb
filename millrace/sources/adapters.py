"""Views that put the generated tables into the shapes of the operational data.

Each view is one SQL text that Spark and the oracle both understand; {names} are tables or other views.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from millrace.session import dealt

VIEWS = {
    "warehouse_operation": """
        SELECT event_id AS operation_id, concat('', user_id) AS employee_id, concat('Employee ', user_id) AS employee_name,
               event_type AS operation_type, ts AS start_time, value AS duration_seconds
        FROM {events}""",
    "daily": """
        SELECT CAST(start_time AS DATE) AS operation_date, employee_id, employee_name, operation_type,
               count(*) AS total_operations, sum(duration_seconds) AS total_duration, avg(duration_seconds) AS avg_duration
        FROM {warehouse_operation}
        GROUP BY CAST(start_time AS DATE), employee_id, employee_name, operation_type""",
    "picking_operation": """
        SELECT l_orderkey AS picking_route_id, l_partkey AS item_id, concat(l_returnflag, l_linestatus) AS mark_code,
               l_returnflag AS act_type, l_quantity AS picked_qty, l_quantity * l_discount AS waste_qty,
               l_shipdate AS operation_date, l_suppkey AS supplier_id
        FROM {lineitem}""",
    "picking": """
        SELECT picking_route_id, item_id, sum(picked_qty) AS total_picked, sum(waste_qty) AS total_waste,
               CASE WHEN sum(picked_qty) > 0 THEN sum(waste_qty) / sum(picked_qty) ELSE 0.0 END AS waste_rate,
               count(*) AS operation_count
        FROM {picking_operation} GROUP BY picking_route_id, item_id""",
    "marking": """
        SELECT mark_code, item_id, count(*) AS usage_count, sum(picked_qty) AS total_picked
        FROM {picking_operation} GROUP BY mark_code, item_id""",
    "serial_mark": """
        SELECT l_partkey AS item_id, l_returnflag AS mark_code, l_linestatus = 'F' AS accepted, l_discount > 0.08 AS blocked,
               l_tax > 0.07 AS is_defect, l_returnflag = 'R' AS competitor, l_shipdate AS mark_date
        FROM {lineitem}""",
    "picking_route": """
        SELECT o_orderkey AS picking_route_id, concat('', o_custkey) AS employee_id, concat('Customer ', o_custkey) AS employee_name,
               o_orderstatus AS status, o_orderdate AS start_date, max(l_shipdate) AS end_date
        FROM {orders} LEFT JOIN {lineitem} ON l_orderkey = o_orderkey
        GROUP BY o_orderkey, o_custkey, o_orderstatus, o_orderdate""",
    "pack_task": """
        SELECT l_orderkey AS picking_route_id, l_linenumber AS task_id, l_extendedprice AS qty, l_quantity AS picked_qty,
               l_quantity * l_discount AS waste_qty
        FROM {lineitem}""",
    "order_trans": """
        SELECT l_orderkey AS order_id, l_extendedprice AS qty, l_quantity AS picked_qty, l_quantity * l_discount AS waste_qty,
               l_shipdate AS created_datetime
        FROM {lineitem}""",
    "sales_order": """
        SELECT o_custkey AS customer_account, o_orderkey AS sales_id, o_orderdate AS invoice_date, o_orderpriority AS currency_code
        FROM {orders}""",
    "purchase_order": """
        SELECT l_suppkey AS vendor_account, l_orderkey AS purchase_id, l_shipdate AS order_date, l_returnflag AS currency_code
        FROM {lineitem}""",
    "raw_sales": """
        SELECT CASE WHEN o_orderkey % 17 = 0 THEN concat(' ', o_orderkey, ' ')
                    WHEN o_orderkey % 53 = 0 THEN concat('A', o_orderkey)
                    WHEN o_orderkey % 101 = 0 THEN concat('99999999999999999999', o_orderkey)
                    WHEN o_orderkey % 211 = 0 THEN '' WHEN o_orderkey % 307 = 0 THEN NULL ELSE concat('', o_orderkey) END AS recid,
               concat('SO', o_orderkey) AS salesid,
               CASE WHEN o_custkey % 13 = 0 THEN '  ' WHEN o_custkey % 7 = 0 THEN concat(' ', o_custkey) ELSE concat('', o_custkey) END AS custaccount,
               CASE WHEN o_orderkey % 11 = 0 THEN '1900-01-01' WHEN o_orderkey % 29 = 0 THEN 'n/a' WHEN o_orderkey % 31 = 0 THEN ''
                    ELSE concat('', CAST(o_orderdate AS DATE)) END AS deliverydate,
               CASE WHEN o_orderkey % 19 = 0 THEN '1e3' WHEN o_orderkey % 23 = 0 THEN 'NaN' WHEN o_orderkey % 37 = 0 THEN 'x1'
                    ELSE concat(' ', CAST(round(o_totalprice * 100) AS BIGINT)) END AS amount,
               o_orderpriority AS currencycode, o_orderstatus AS salesstatus,
               concat('', CAST(o_orderdate AS DATE)) AS modifieddatetime, CASE WHEN o_orderkey % 2 = 0 THEN 'a1' ELSE 'b2' END AS dataareaid
        FROM {orders}""",
    "raw_line": """
        SELECT CASE WHEN l_partkey % 41 = 0 THEN concat('K', l_orderkey) ELSE concat(' ', l_orderkey * 10 + l_linenumber) END AS recid, concat('', l_orderkey) AS orderid,
               CASE WHEN l_partkey % 19 = 0 THEN '  ' ELSE concat('', l_partkey) END AS itemid, concat('', l_suppkey) AS vendor, concat(l_returnflag, l_linestatus) AS markcode,
               CASE WHEN l_partkey % 23 = 0 THEN '1e2' WHEN l_partkey % 29 = 0 THEN 'NaN' ELSE concat('', CAST(l_quantity AS BIGINT)) END AS qty,
               CASE WHEN l_partkey % 31 = 0 THEN '1900-01-01' WHEN l_partkey % 37 = 0 THEN '' ELSE concat('', CAST(l_shipdate AS DATE)) END AS created, 'a1' AS dataareaid
        FROM {lineitem}""",
    "old_sales": """
        SELECT o_orderkey AS sales_id, o_custkey AS customer, CASE WHEN o_orderkey % 7 = 0 THEN 'old' ELSE o_orderpriority END AS priority,
               CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderstatus END AS status
        FROM {orders} WHERE o_orderkey % 5 <> 0""",
    "new_sales": """
        SELECT o_orderkey AS sales_id, o_custkey AS customer, o_orderpriority AS priority, o_orderstatus AS status
        FROM {orders} WHERE o_orderkey % 3 <> 0""",
    "load_chunk": """
        SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS chunk_no, event_id AS chunk_id,
               CASE WHEN event_id % 7 = 0 THEN 'retry' WHEN event_id % 8 = 0 THEN 'pending' WHEN event_type = 'view' THEN 'running'
                    WHEN event_type = 'purchase' THEN 'ready_to_commit' WHEN event_type = 'signup' THEN 'writing'
                    WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'failed' ELSE 'completed' END AS status,
               concat('w', event_id % 4) AS worker_id, event_id % 6 AS attempt_count, CAST(floor(value * 100) AS BIGINT) AS rows_read,
               CAST(floor(value * 100) AS BIGINT) - event_id % 3 AS rows_inserted, event_id % 3 AS rows_conflicted, ts AS started_at,
               CASE WHEN event_id % 10 = 0 THEN NULL ELSE ts END AS heartbeat_at, ts AS updated_at, value AS seconds,
               CASE WHEN event_type = 'error' THEN 'io' END AS error_type
        FROM {events}""",
    "load_run": """
        SELECT run_id, concat('pipeline ', run_id % 5) AS pipeline_name, min(started_at) AS started_at, max(started_at) AS finished_at,
               CAST(sum(rows_read) * 2 AS BIGINT) AS declared_rows
        FROM {load_chunk} GROUP BY run_id""",
    "chunk_range": """
        SELECT run_id, chunk_no, chunk_id, rows_read, rows_inserted, status,
               chunk_no * 100 - CASE WHEN chunk_no % 11 = 0 THEN 10 ELSE 0 END AS range_start,
               chunk_no * 100 + CASE WHEN chunk_no % 13 = 0 THEN 90 WHEN chunk_no % 17 = 0 THEN -5 ELSE 100 END AS range_end
        FROM {load_chunk}""",
    "issue": """
        SELECT o_orderkey AS issue_id, concat('ISS-', o_orderkey) AS issue_key, o_orderstatus AS status, o_orderpriority AS priority,
               o_custkey AS assignee_id, o_custkey % 50 AS reporter_id, CAST(o_orderdate AS DATE) AS created,
               CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS due, o_totalprice AS points
        FROM {orders}""",
}


# Views with about as many groups as rows: adding up before the shuffle saves nothing, and what a task holds grows with the rows
# it gets. Their source is dealt by the groups' keys first.
DEALT = {"picking": ("picking_operation", ["picking_route_id", "item_id"])}


def uses(text: str) -> list[str]:
    return re.findall(r"\{(\w+)\}", text)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A generated table or one of VIEWS over it, as a lazy DataFrame."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = VIEWS[name]
    sources = {n: view(spark, sf_dir, n) for n in set(uses(text))}
    if name in DEALT:
        source, keys = DEALT[name]
        sources[source] = dealt(sources[source], keys)
    return spark.sql(text, **sources)


def oracle(sql: str) -> str:
    """The SQL with the views it names in front, as common table expressions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for n in uses(text):
            if n in VIEWS and n not in needed:
                visit(VIEWS[n])
                needed.append(n)

    visit(sql)
    plain = lambda text: re.sub(r"\{(\w+)\}", r"\1", text)
    head = ",\n".join(f"{n} AS ({plain(VIEWS[n])})" for n in needed)
    body = plain(sql).strip().replace(", 6)", " + 1e-9, 6)")  # the shift of functions.columns.r6
    body = body.replace("count_if(", "count(*) FILTER (")  # count_if is a huge integer in the oracle's engine
    if not head:
        return body
    return f"WITH {head},\n{body[4:].lstrip()}" if body[:5].upper() == "WITH " else f"WITH {head}\n{body}"
