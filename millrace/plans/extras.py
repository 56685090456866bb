"""Queries of predicates, joins, windows, history and reports that stand alone."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import columns as c
from millrace.operators import features, items, marts, monitoring, quality
from millrace.plans import items as item_plans
from millrace.plans import monitoring as history
from millrace.plans.registry import query
from millrace.sources.adapters import view


@query("n06_guarded_timestamp", "SELECT salesid, CASE WHEN regexp_matches(trim(deliverydate), '^\\d\\d\\d\\d-\\d\\d-\\d\\d') THEN TRY_CAST(trim(deliverydate) AS TIMESTAMP) END AS delivery FROM {raw_sales}")
def n06(spark, d):
    return view(spark, d, "raw_sales").select("salesid", c.to_ts(F.col("deliverydate"), guard=True).alias("delivery"))


@query("n14_difference", "SELECT picking_route_id, item_id, picked_qty - waste_qty AS diff FROM {picking_operation}")
def n14(spark, d):
    return view(spark, d, "picking_operation").select("picking_route_id", "item_id", (F.col("picked_qty") - F.col("waste_qty")).alias("diff"))


@query("n17_duration_seconds", "SELECT picking_route_id, CAST(epoch(end_date - start_date) AS DOUBLE) AS seconds FROM {picking_route}")
def n17(spark, d):
    return view(spark, d, "picking_route").select("picking_route_id", c.seconds_between(F.col("start_date"), F.col("end_date")).alias("seconds"))


@query("n20_safe_ratio", "SELECT picking_route_id, item_id, round(CASE WHEN picked_qty - 10 > 0 THEN waste_qty / (picked_qty - 10) ELSE 0 END, 6) AS ratio FROM {picking_operation}")
def n20(spark, d):
    return view(spark, d, "picking_operation").select("picking_route_id", "item_id", c.r6(c.safe_div(F.col("waste_qty"), F.col("picked_qty") - 10)).alias("ratio"))


@query("n21_fill_zero", "SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END, 0) AS price FROM orders")
def n21(spark, d):
    return view(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("price")).na.fill(0)


@query("p01_not_null_key", "SELECT salesid, recid FROM {raw_sales} WHERE recid IS NOT NULL")
def p01(spark, d):
    return view(spark, d, "raw_sales").where("recid is not null").select("salesid", "recid")


_FOCUS = "status <> 'F' AND (lower(priority) IN ('1-urgent', '2-high') OR due < DATE '1998-01-01' OR due IS NULL)"


@query("p04_focus_conditions", f"SELECT issue_key FROM {{issue}} WHERE {_FOCUS}")
def p04(spark, d):
    any_of = F.lower("priority").isin("1-urgent", "2-high") | (F.col("due") < F.lit("1998-01-01").cast("date")) | F.col("due").isNull()
    return view(spark, d, "issue").where((F.col("status") != "F") & any_of).select("issue_key")


@query("p05_relative_dates", "SELECT issue_key, due <= DATE '1998-06-18' AS due_soon, due < DATE '1998-06-15' AS overdue, created >= DATE '1998-06-08' AS fresh FROM {issue} WHERE due IS NOT NULL")
def p05(spark, d):
    day = lambda x: F.lit(x).cast("date")
    return view(spark, d, "issue").where("due is not null").select("issue_key", (F.col("due") <= day("1998-06-18")).alias("due_soon"), (F.col("due") < day("1998-06-15")).alias("overdue"), (F.col("created") >= day("1998-06-08")).alias("fresh"))


@query("p06_time_window", "SELECT event_id FROM events WHERE strftime(ts, '%H:%M:%S') BETWEEN '09:00:00' AND '17:50:00'")
def p06(spark, d):
    return view(spark, d, "events").where(F.date_format("ts", "HH:mm:ss").between("09:00:00", "17:50:00")).select("event_id")


@query("p10_conditional_counts", "SELECT user_id, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (value > 50) AS large FROM events GROUP BY user_id")
def p10(spark, d):
    return view(spark, d, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("errors"), F.count_if(F.col("value") > 50).alias("large"))


@query("j08_staged_for_status", "SELECT event_id FROM events WHERE event_id IN (SELECT chunk_id FROM {load_chunk} WHERE status = 'completed')")
def j08(spark, d):
    done = view(spark, d, "load_chunk").where("status = 'completed'").select(F.col("chunk_id").alias("event_id"))
    return view(spark, d, "events").join(done, "event_id", "left_semi").select("event_id")


@query("j09_orphans", "SELECT l_orderkey AS chunk_id, count(*) AS rows FROM lineitem WHERE l_orderkey NOT IN (SELECT event_id FROM events) GROUP BY l_orderkey")
def j09(spark, d):
    known = view(spark, d, "events").select(F.col("event_id").alias("chunk_id"))
    return view(spark, d, "lineitem").select(F.col("l_orderkey").alias("chunk_id")).join(known, "chunk_id", "left_anti").groupBy("chunk_id").agg(F.count("*").alias("rows"))


@query("j13_available_priorities", "SELECT DISTINCT o_orderpriority AS available FROM orders WHERE lower(o_orderpriority) IN ('1-urgent', '5-low', 'none')")
def j13(spark, d):
    wanted = spark.createDataFrame([("1-URGENT",), ("5-low",), ("none",)], "name string").select(F.lower("name").alias("low"))
    have = view(spark, d, "orders").select(F.col("o_orderpriority").alias("available")).distinct().withColumn("low", F.lower("available"))
    return have.join(F.broadcast(wanted), "low").select("available")


@query("j15_latest_run", "SELECT run_id, started_at FROM {load_run} ORDER BY started_at DESC, run_id DESC LIMIT 1")
def j15(spark, d):
    return features.top_k(view(spark, d, "load_run"), [F.desc("started_at"), F.desc("run_id")], 1).select("run_id", "started_at")


@query("w01_snapshot_deltas", """
SELECT run_id, day, rows_total, round(rows_total - lag(rows_total) OVER w, 6) AS delta, date_diff('day', lag(day) OVER w, day) AS days
FROM (SELECT run_id, CAST(started_at AS DATE) AS day, CAST(sum(sum(rows_read)) OVER (PARTITION BY run_id ORDER BY CAST(started_at AS DATE)) AS BIGINT) AS rows_total FROM {load_chunk} GROUP BY run_id, CAST(started_at AS DATE)) WINDOW w AS (PARTITION BY run_id ORDER BY day)""")
def w01(spark, d):
    w = Window.partitionBy("run_id").orderBy("day")
    days = view(spark, d, "load_chunk").groupBy("run_id", F.to_date("started_at").alias("day")).agg(F.sum("rows_read").alias("rows")).withColumn("rows_total", F.sum("rows").over(w))
    return days.select("run_id", "day", "rows_total", c.r6((F.col("rows_total") - F.lag("rows_total").over(w)).cast("double")).alias("delta"), F.datediff("day", F.lag("day").over(w)).cast("long").alias("days"))


@query("w03_moving_mean", "SELECT user_id, event_id, CASE WHEN count(*) OVER w = 7 THEN round(avg(value) OVER w, 6) END AS value_ma7 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)")
def w03(spark, d):
    return features.moving_mean(view(spark, d, "events"), "value", 7, ["ts", "event_id"], ["user_id"]).select("user_id", "event_id", "value_ma7")


@query("t05_priority_due_updated", "SELECT issue_key, priority, due FROM {issue} ORDER BY substr(priority, 1, 1), due ASC NULLS LAST, issue_id LIMIT 100")
def t05(spark, d):
    return features.top_k(view(spark, d, "issue"), [F.substring("priority", 1, 1), F.asc_nulls_last("due"), "issue_id"], 100).select("issue_key", "priority", "due")


@query("t06_sort_by_name", "SELECT c_custkey, c_name FROM customer ORDER BY lower(coalesce(nullif(c_name, ''), CAST(c_custkey AS VARCHAR))), c_custkey LIMIT 25")
def t06(spark, d):
    return features.top_k(view(spark, d, "customer"), [F.lower(F.coalesce(F.nullif("c_name", F.lit("")), F.col("c_custkey").cast("string"))), "c_custkey"], 25).select("c_custkey", "c_name")


@query("t07_cap_reached", "SELECT count(*) > 1000 AS reached FROM orders")
def t07(spark, d):
    return view(spark, d, "orders").limit(1001).agg((F.count("*") > 1000).alias("reached"))


@query("t08_sample")
def t08(spark, d):
    return view(spark, d, "lineitem").sample(0.1, 42)


@query("i07_numeric_key", "SELECT salesid, CASE WHEN regexp_matches(trim(recid), '^[0-9]+$') THEN TRY_CAST(trim(recid) AS BIGINT) END AS recid_bigint FROM {raw_sales}")
def i07(spark, d):
    return view(spark, d, "raw_sales").withColumn("recid_bigint", c.to_bigint(F.col("recid"))).select("salesid", "recid_bigint")


@query("q13_timestamp_failures", "SELECT count_if(nullif(trim(deliverydate), '') IS NOT NULL AND TRY_CAST(trim(deliverydate) AS TIMESTAMP) IS NULL) AS failing FROM {raw_sales}")
def q13(spark, d):
    return quality.castable_gate(view(spark, d, "raw_sales"), {"deliverydate": "timestamp_ntz"}).select("failing")


@query("q15_preflight", """
SELECT 'column o_custkey' AS "check", 'OK' AS status FROM (SELECT count(*) FROM orders) UNION ALL SELECT 'column o_missing', 'BLOCKED' UNION ALL SELECT 'key o_orderkey', 'OK' UNION ALL SELECT 'verdict', 'BLOCKED'""")
def q15(spark, d):
    return quality.preflight(view(spark, d, "orders"), "o_orderkey", ["o_custkey", "o_missing"])


@query("q16_dead_letters", "SELECT 'bad key' AS reason, count(*) AS n FROM {raw_sales} WHERE TRY_CAST(CASE WHEN regexp_matches(trim(recid), '^[0-9]+$') THEN trim(recid) END AS BIGINT) IS NULL")
def q16(spark, d):
    from millrace.operators.cleaning import split_rejects

    _, bad = split_rejects(view(spark, d, "raw_sales"), {"bad key": c.to_bigint(F.col("recid")).isNull()})
    return bad.groupBy("reason").agg(F.count("*").alias("n"))


@query("d05_tables_present", "SELECT t AS table_name, t IN ('orders', 'customer') AS present FROM (SELECT unnest(['orders', 'customer', 'no_such']) AS t), (SELECT count(*) FROM orders)")
def d05(spark, d):
    cat = quality.catalog({t: view(spark, d, t) for t in ("orders", "customer")})
    want = spark.createDataFrame([("orders",), ("customer",), ("no_such",)], "table_name string")
    return want.join(cat.select("table_name", F.lit(True).alias("p")).distinct(), "table_name", "left").select("table_name", F.coalesce("p", F.lit(False)).alias("present"))


@query("m04_active_workers", f"SELECT run_id, chunk_id, worker_id, round({history._UPD}, 6) AS elapsed, round(rows_read / ({history._UPD}), 6) AS rows_per_second FROM {{load_chunk}} WHERE status = 'running'")
def m04(spark, d):
    a = monitoring.age("updated_at", history.AS_OF)
    return view(spark, d, "load_chunk").where("status = 'running'").select("run_id", "chunk_id", "worker_id", c.r6(a).alias("elapsed"), c.r6(F.col("rows_read") / a).alias("rows_per_second"))


@query("m14_snapshot", f"SELECT run_id, total_chunks, completed_chunks, failed_chunks, rows_read, CASE WHEN completed_chunks = total_chunks THEN 'COMPLETED' WHEN failed_chunks > 0 THEN 'CRITICAL' WHEN active_chunks > 0 OR retry_chunks > 5 THEN 'WARNING' ELSE 'HEALTHY' END AS verdict FROM ({history._TOTALS})")
def m14(spark, d):
    x = F.col
    verdict = F.when(x("completed_chunks") == x("total_chunks"), "COMPLETED").when(x("failed_chunks") > 0, "CRITICAL").when((x("active_chunks") > 0) | (x("retry_chunks") > 5), "WARNING").otherwise("HEALTHY")
    return history.a17(spark, d).select("run_id", "total_chunks", "completed_chunks", "failed_chunks", "rows_read", verdict.alias("verdict"))


@query("m23_table_status", f"SELECT run_id, round(100.0 * completed_rows / rows_read, 6) AS completion_pct, rows_read - completed_rows AS rows_left FROM ({history._TOTALS}) WHERE rows_read > 0")
def m23(spark, d):
    t = history.a17(spark, d).where("rows_read > 0")
    return t.select("run_id", c.r6(100.0 * F.col("completed_rows") / F.col("rows_read")).alias("completion_pct"), (F.col("rows_read") - F.col("completed_rows")).alias("rows_left"))


@query("a21_phase_summary", "SELECT status, round(sum(seconds), 6) AS elapsed, CAST(sum(rows_read) AS BIGINT) AS rows, round(sum(rows_read) / sum(seconds), 6) AS rows_per_second FROM {load_chunk} GROUP BY status")
def a21(spark, d):
    return view(spark, d, "load_chunk").groupBy("status").agg(c.r6(F.sum("seconds")).alias("elapsed"), F.sum("rows_read").alias("rows"), c.r6(F.sum("rows_read") / F.sum("seconds")).alias("rows_per_second"))


@query("x18_weekday_by_month", "SELECT CAST(isodow(ts) - 1 AS INTEGER) AS weekday, " + ", ".join(f"count(*) FILTER (month(ts) = {k}) AS m{k}" for k in range(1, 13)) + " FROM events GROUP BY 1")
def x18(spark, d):
    return view(spark, d, "events").groupBy(F.weekday("ts").alias("weekday")).agg(*[F.count_if(F.month("ts") == k).alias(f"m{k}") for k in range(1, 13)])


@query("z04_idle_time", """
SELECT employee_id, CAST(count(*) AS BIGINT) AS gaps, round(sum(gap), 6) AS idle_seconds FROM (
  SELECT employee_id, (epoch_us(lead(start_time) OVER w) - epoch_us(start_time)) / 1e6 AS gap, CAST(lead(start_time) OVER w AS DATE) = CAST(start_time AS DATE) AS same_day FROM {warehouse_operation} WINDOW w AS (PARTITION BY employee_id ORDER BY start_time, operation_id))
WHERE same_day AND gap > 3600 GROUP BY employee_id""")
def z04(spark, d):
    w = Window.partitionBy("employee_id").orderBy("start_time", "operation_id")
    nxt = F.lead("start_time").over(w)
    g = view(spark, d, "warehouse_operation").select("employee_id", c.seconds_between(F.col("start_time"), nxt).alias("gap"), (F.to_date(nxt) == F.to_date("start_time")).alias("same_day"))
    return g.where("same_day and gap > 3600").groupBy("employee_id").agg(F.count("*").alias("gaps"), c.r6(F.sum("gap")).alias("idle_seconds"))


@query("k09_related_issues", f"SELECT issue_key FROM ({item_plans._SQL_ISSUES}) WHERE assignee IN ({item_plans._MEMBERS}) OR reporter IN ({item_plans._MEMBERS}) OR creator IN ({item_plans._MEMBERS}) OR issue_key IN (SELECT issue_key FROM ({item_plans._SQL_EVENTS}) WHERE author IN ({item_plans._MEMBERS}))")
def k09(spark, d):
    return items.related(item_plans._issues(spark, d), item_plans._events(spark, d), item_plans._members(spark, d))


def _categories(name: str, key: str) -> None:
    @query(key, f"SELECT issue_key, score, reasons, changed FROM ({item_plans._TASKS}) WHERE contains('|' || categories || '|', '|{name}|')")
    def run(spark, d):
        return items.sheet(item_plans._tasks(spark, d), name).select("issue_key", "score", F.array_join("reasons", "|").alias("reasons"), F.array_join("changed", "|").alias("changed"))


for _name, _key in (("active_now", "k17_active_now"), ("changed_recently", "k18_changed_recently"), ("stale", "k20_stale"), ("overdue", "k21_overdue")):
    _categories(_name, _key)


@query("k11_last_activity", f"SELECT issue_key, active_users, days_idle, days_overdue, last_activity FROM ({item_plans._TASKS})")
def k11(spark, d):
    return item_plans._tasks(spark, d).select("issue_key", F.array_join("active_users", "|").alias("active_users"), "days_idle", "days_overdue", "last_activity")


_NAME = "regexp_extract(regexp_replace(url, '[?#].*', ''), '[^/]*$', 0)"
_MIME = "CASE page_id % 5 WHEN 0 THEN 'image/png' WHEN 1 THEN 'application/pdf' WHEN 2 THEN 'application/vnd.ms-excel' WHEN 3 THEN 'application/json' ELSE '' END"


@query("k30_attachment_classes", f"""
SELECT page_id, CASE WHEN ext IN ('png', 'jpg', 'jpeg', 'gif', 'bmp', 'webp', 'svg') OR starts_with(mime, 'image/') THEN 'image' WHEN ext = 'pdf' OR contains(mime, 'pdf') THEN 'pdf' WHEN ext IN ('doc', 'docx') OR contains(mime, 'word') THEN 'document'
  WHEN ext IN ('xls', 'xlsx') OR contains(mime, 'excel') OR contains(mime, 'spreadsheet') THEN 'table' WHEN ext = 'xml' OR contains(mime, 'xml') THEN 'xml' WHEN ext = 'json' OR contains(mime, 'json') THEN 'json' ELSE 'other' END AS kind
FROM (SELECT page_id, lower(regexp_extract({_NAME}, '\\.([^.]+)$', 1)) AS ext, {_MIME} AS mime FROM pages)""")
def k30(spark, d):
    """Page files as attachments: the name is the URL's last part; the type is made up from the id."""
    rows = view(spark, d, "pages").select("page_id", F.expr(_NAME).alias("name"), F.expr(_MIME).alias("mime"))
    return rows.select("page_id", items.attachment_class(F.col("name"), F.col("mime")).alias("kind"))


@query("k34_relevance_search", """
WITH a AS (SELECT doc_id, split_part(text, chr(10), 1) AS summary, text, doc_id % 97 AS updated FROM documents),
u AS (SELECT *, 0 AS search FROM a WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, upper(summary), text, updated + 1, 1 FROM a WHERE doc_id % 3 = 0),
f AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY search) = 1)
SELECT doc_id AS issue_key, updated, search FROM f WHERE contains(lower(summary), 'licensed') OR contains(lower(left(text, 200)), 'licensed') OR contains(lower(summary), 'the') OR contains(lower(left(text, 200)), 'the')""")
def k34(spark, d):
    a = view(spark, d, "documents").select(F.col("doc_id").alias("issue_key"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("summary"), "text", (F.col("doc_id") % 97).alias("updated"))
    second = a.where("issue_key % 3 = 0").withColumns({"summary": F.upper("summary"), "updated": F.col("updated") + 1})
    return items.relevance_search([a.where("issue_key % 2 = 0"), second], ["licensed", "the"])


# registry rows from the benchmark: a cell for the mode, the item's text as description, now and then a category
_MODES = [("Mode A / stock", ["inventory", "stock take"], ["CommitLine", "StockForm"]), ("Mode B", ["remains", "tion"], ["RemainsDto"]), ("Mode C", [], [])]
_CATEGORIES, _DEFAULT = ["error", "the", "screen"], "rules"
_BY_CATEGORY = {"the": ["licensed", "The"], "rules": ["rights"]}
_CELL = "CASE item_id % 5 WHEN 0 THEN 'mode a' WHEN 1 THEN 'see INVENTORY here' WHEN 2 THEN 'none such' WHEN 3 THEN 'about Mode C, old' ELSE 'zzz' END"
_REGISTRY = f"""
WITH r AS (SELECT item_id AS entry, {_CELL} AS mode_text, concat(text, ' `Code ', item_id % 3, '` AutoStockForm CommitTask') AS description, CASE WHEN item_id % 4 = 0 THEN 'given' ELSE '' END AS category_text FROM benchmark),
m AS (SELECT *, CASE WHEN item_id5 IN (0, 1) THEN 'Mode A / stock' WHEN item_id5 = 3 THEN 'Mode C'
    WHEN contains(lower(description), 'mode a / stock') OR contains(lower(description), 'inventory') OR contains(lower(description), 'stock take') THEN 'Mode A / stock'
    WHEN contains(lower(description), 'mode b') OR contains(lower(description), 'remains') OR contains(lower(description), 'tion') THEN 'Mode B' WHEN contains(lower(description), 'mode c') THEN 'Mode C' ELSE mode_text END AS mode,
  CASE WHEN category_text <> '' THEN category_text WHEN contains(lower(description), 'error') THEN 'error' WHEN contains(lower(description), 'the') THEN 'the' WHEN contains(lower(description), 'screen') THEN 'screen' ELSE 'rules' END AS category FROM (SELECT *, entry % 5 AS item_id5 FROM r)),
p AS (SELECT entry, mode, category, list_concat(CASE mode WHEN 'Mode A / stock' THEN ['CommitLine', 'StockForm'] WHEN 'Mode B' THEN ['RemainsDto'] ELSE [] END, list_concat(regexp_extract_all(description, '`([^`]+)`', 1), regexp_extract_all(description, '\\b([A-Z][a-zA-Z]+(?:Dto|Form|Service|Inventory|Line|Task))\\b', 1))) AS words FROM m),
k AS (SELECT entry, mode, category, list_filter(words, lambda x, i: NOT list_contains(list_transform(words[1:i - 1], lambda y: lower(y)), lower(x))) AS keywords FROM p)
"""


def _registry(spark, d):
    rows = view(spark, d, "benchmark").select(F.col("item_id").alias("entry"), F.expr(_CELL).alias("mode_text"), F.expr("concat(text, ' `Code ', item_id % 3, '` AutoStockForm CommitTask')").alias("description"), F.expr("CASE WHEN item_id % 4 = 0 THEN 'given' ELSE '' END").alias("category_text"))
    return items.parse_registry(rows, _MODES, _CATEGORIES, _DEFAULT)


@query("k25_registry_keywords", _REGISTRY + "SELECT entry, mode, category, array_to_string(keywords, '|') AS keywords FROM k")
def k25(spark, d):
    return _registry(spark, d).select("entry", "mode", "category", F.array_join("keywords", "|").alias("keywords"))


@query("k26_keyword_candidates", _REGISTRY + """, w AS (SELECT entry, unnest(list_concat(keywords, list_concat(['stea', 'Thin'], CASE category WHEN 'the' THEN ['licensed', 'The'] WHEN 'rules' THEN ['rights'] ELSE [] END))) AS word FROM k)
SELECT DISTINCT entry, doc_id AS issue_key FROM w JOIN documents ON contains(lower(text), lower(word)) WHERE source IN ('src1', 'src2', 'src3', 'src5', 'src8', 'src13')""")
def k26(spark, d):
    wanted = items.search_keywords(_registry(spark, d), ["stea", "Thin"], _BY_CATEGORY)
    texts = view(spark, d, "documents").select(F.col("doc_id").alias("issue_key"), "text", F.col("source").alias("project"))
    return items.match_candidates(wanted, texts, projects=["SRC1", "src2", "src3", "src5", "src8", "src13"])
