"""Queries of staged chunks and of schema versions read from rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.operators import audit, loading
from millrace.operators import monitoring as m
from millrace.operators import schema_history as sh
from millrace.operators import staging as st
from millrace.plans.registry import query
from millrace.session import shared_dir
from millrace.sources.adapters import view

CHUNKS = 6

# An order's key is inserted by the first chunk that is moved; here chunks go in descending order.
_MOVED = f"""
SELECT chunk_id, l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY chunk_id DESC, l_linenumber, l_quantity) AS r, l_linenumber
FROM (SELECT l_suppkey % {CHUNKS} AS chunk_id, l_orderkey, l_linenumber, l_quantity FROM lineitem)"""


@query("s17_staged_chunks", f"""
SELECT CAST(chunk_id AS BIGINT) AS chunk_id, count(*) AS rows_read, count(*) FILTER (r = 1) AS rows_inserted, count(*) FILTER (r > 1) AS rows_conflicted,
       CAST(coalesce(sum(l_orderkey * l_linenumber) FILTER (r = 1), 0) AS BIGINT) AS key_sum
FROM ({_MOVED}) GROUP BY chunk_id""")
def s17(spark, d):
    """Lines staged by supplier, twice; every chunk moved, and the first one moved again at the end."""
    lines = view(spark, d, "lineitem")
    data = lines.select("l_orderkey", "l_linenumber", "l_quantity")
    root = f"{shared_dir(spark)}/staged-{uuid.uuid4().hex}"
    staging, target = f"{root}/staging", f"{root}/target"
    for _ in range(2):
        st.stage(lines.select(*data.columns, (F.col("l_suppkey") % CHUNKS).alias(st.CHUNK)), staging, F.col(st.CHUNK))
    for chunk in [*reversed(range(CHUNKS)), CHUNKS - 1]:
        st.finalize_chunk(spark, staging, target, data.schema, ["l_orderkey"], chunk)
    moved = st.chunks_of(spark, target, data.schema)
    counts = st.chunk_counts(st.chunks_of(spark, staging, data.schema), moved)
    sums = moved.groupBy(F.col(st.CHUNK).alias("chunk_id")).agg(F.sum(F.col("l_orderkey") * F.col("l_linenumber")).alias("key_sum"))
    return counts.join(sums, "chunk_id", "left").fillna(0, ["key_sum"])


# Extracts of sales and of lines as they came in: first with faulty keys blanked, then raw, again raw, and at last without a column.
_BATCHES = (
    ("sales", "SELECT CASE WHEN {whole} THEN recid END AS recid, custaccount, amount, modifieddatetime FROM {raw_sales}", ("recid", "custaccount", "amount", "modifieddatetime")),
    ("lines", "SELECT orderid, itemid, qty FROM {raw_line}", ("orderid", "itemid", "qty")),
    ("sales", "SELECT recid, custaccount, amount, modifieddatetime, salesstatus FROM {raw_sales}", ("recid", "custaccount", "amount", "modifieddatetime", "salesstatus")),
    ("sales", "SELECT recid, custaccount, amount, modifieddatetime, salesstatus FROM {raw_sales}", ("recid", "custaccount", "amount", "modifieddatetime", "salesstatus")),
    ("lines", "SELECT orderid, itemid, qty, vendor, created FROM {raw_line}", ("orderid", "itemid", "qty", "vendor", "created")),
    ("sales", "SELECT recid, amount, modifieddatetime, salesstatus FROM {raw_sales}", ("recid", "amount", "modifieddatetime", "salesstatus")),
)
_CLEAN_KEY = "length(trim(recid)) <= 18 AND trim(recid) NOT LIKE 'A%'"


def _types_sql(n: int, table: str, source: str, columns: tuple[str, ...]) -> str:
    """One row per column of a batch: its type by the same forms, written for the oracle."""
    fits = lambda c, form: f"bool_and(regexp_matches(trim({c}), '{form}'))"
    rows = []
    for i, c in enumerate(columns):
        v = f"CASE WHEN trim({c}) <> '' THEN {c} END"
        kind = f"""CASE WHEN count({v}) = 0 THEN 'void' WHEN {fits(v, sh.WHOLE)} THEN 'bigint' WHEN {fits(v, sh.DECIMAL)} THEN 'decimal'
            WHEN bool_and(TRY_CAST(trim({v}) AS TIMESTAMP) IS NOT NULL) FILTER ({v} IS NOT NULL) THEN 'timestamp' ELSE 'text' END"""
        rows.append(f"SELECT {n} AS batch, '{table}' AS table_name, {i + 1} AS position, '{c}' AS name, {kind} AS type FROM (SELECT * FROM b{n})")
    return "\nUNION ALL ".join(rows)


def _history_sql() -> str:
    sources = ", ".join(f"b{n} AS ({s.replace('{whole}', _CLEAN_KEY)})" for n, (_, s, _) in enumerate(_BATCHES))
    types = "\nUNION ALL ".join(_types_sql(n, t, s, c) for n, (t, s, c) in enumerate(_BATCHES))
    return f"""
WITH {sources}, types AS ({types}),
whole AS (SELECT batch, table_name, string_agg(name || ':' || type, ',' ORDER BY position) AS columns FROM types GROUP BY batch, table_name),
changed AS (SELECT *, lag(columns) OVER (PARTITION BY table_name ORDER BY batch) AS was FROM whole),
versions AS (SELECT batch, table_name, columns, row_number() OVER (PARTITION BY table_name ORDER BY batch) AS version FROM changed WHERE columns IS DISTINCT FROM was),
own AS (SELECT v.table_name, v.version, t.name, t.type FROM versions v JOIN types t ON t.batch = v.batch),
pairs AS (SELECT coalesce(a.table_name, b.table_name) AS table_name, coalesce(a.version, b.version + 1) AS version, coalesce(a.name, b.name) AS name, a.type AS now, b.type AS was
          FROM own a FULL OUTER JOIN own b ON a.table_name = b.table_name AND a.version = b.version + 1 AND a.name = b.name),
drift AS (SELECT table_name, version, coalesce(string_agg(name, ',' ORDER BY name) FILTER (was IS NULL AND version > 1), '') AS added, coalesce(string_agg(name, ',' ORDER BY name) FILTER (now IS NULL), '') AS removed,
                 coalesce(string_agg(name, ',' ORDER BY name) FILTER (now <> was), '') AS type_changes FROM pairs GROUP BY table_name, version)
SELECT v.table_name, CAST(v.version AS INTEGER) AS version, v.columns, CASE WHEN v.version = 1 THEN 'new_table' WHEN type_changes <> '' THEN 'type_changed' WHEN removed <> '' THEN 'columns_removed' WHEN added <> '' THEN 'columns_added' END AS drift_type,
       added, removed, type_changes
FROM versions v JOIN drift d ON v.table_name = d.table_name AND v.version = d.version"""


@query("d03_schema_history", _history_sql())
def d03(spark, d):
    """Versions of two tables over six extracts; the second of two equal extracts adds none."""
    path = f"{shared_dir(spark)}/schemas-{uuid.uuid4().hex}"
    for table, source, columns in _BATCHES:
        raw = "raw_sales" if table == "sales" else "raw_line"
        rows = view(spark, d, raw)
        if "{whole}" in source:
            rows = rows.withColumn("recid", F.when(F.expr(_CLEAN_KEY), F.col("recid")))
        sh.append_version(spark, path, sh.inferred_types(rows.select(*columns), table))
    return sh.schema_history(sh.read_history(spark, path)).drop("fingerprint")


@query("l02_recent_audit", """
SELECT run_id, table_name, action, details, actor, created_at FROM (
  SELECT run_id, pipeline_name AS table_name, 'LOAD_COMPLETE' AS action, '{"rows_inserted":' || declared_rows || '}' AS details, 'pipeline' AS actor, finished_at AS created_at FROM {load_run}
  UNION ALL SELECT run_id, pipeline_name, 'LOAD_START', NULL, 'pipeline', started_at FROM {load_run}
  UNION ALL SELECT run_id, worker_id, 'ERROR', '{"error_type":"' || error_type || '","chunk":' || chunk_no || '}', 'pipeline', updated_at FROM {load_chunk} WHERE status = 'failed' AND error_type IS NOT NULL)
ORDER BY created_at DESC, action, run_id, details LIMIT 500""")
def l02(spark, d):
    path = f"{shared_dir(spark)}/audit-{uuid.uuid4().hex}"
    runs, failed = view(spark, d, "load_run"), view(spark, d, "load_chunk").where("status = 'failed' and error_type is not null")
    name, run = F.col("pipeline_name"), F.col("run_id")
    audit.append(audit.entries(runs, "LOAD_START", name, run, F.col("started_at")), path)
    audit.append(audit.entries(runs, "LOAD_COMPLETE", name, run, F.col("finished_at"), {"rows_inserted": F.col("declared_rows")}), path)
    audit.append(audit.entries(failed, "ERROR", F.col("worker_id"), run, F.col("updated_at"), {"error_type": F.col("error_type"), "chunk": F.col("chunk_no")}), path)
    return audit.recent(spark.read.parquet(path), limit=500).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query("s09_completed_chunks", """
SELECT run_id, chunk_no, status, attempt_count, rows_read, rows_inserted, rows_conflicted, started_at, started_at + to_seconds(CAST(floor(seconds) AS BIGINT)) AS completed_at,
       CASE WHEN floor(seconds) > 0 THEN CAST(floor(seconds) AS DOUBLE) END AS duration_seconds, CASE WHEN floor(seconds) > 0 THEN CAST(round(rows_read / floor(seconds)) AS BIGINT) END AS rows_per_second
FROM {load_chunk} WHERE status = 'completed'""")
def s09(spark, d):
    """All runs' completed chunks, written as CSV and read again."""
    chunks = view(spark, d, "load_chunk").withColumn("completed_at", F.expr("started_at + make_dt_interval(0, 0, 0, cast(floor(seconds) as decimal(18, 6)))"))
    rows = m.completed_chunks(chunks).withColumn("duration_seconds", F.col("duration_seconds").cast("double"))
    path = f"{shared_dir(spark)}/completed-{uuid.uuid4().hex}"
    loading.write_tsv(rows, path, ",")
    return spark.read.schema(rows.schema).csv(path, header=True, nullValue="", encoding="UTF-8")


@query("s11_members", """
SELECT concat('', c_custkey) AS account_id, c_name AS name, '' AS key, concat('Member ', c_custkey) AS display_name, concat(lower(c_mktsegment), '@example.org') AS email, TRUE AS active
FROM customer WHERE c_custkey % 3 <> 0 AND NOT contains(lower(c_mktsegment), 'machin')""")
def s11(spark, d):
    """Customers as a member list, written as TSV and read again: every third is inactive, one segment is left out."""
    path = f"{shared_dir(spark)}/members-{uuid.uuid4().hex}"
    active = F.when(F.col("c_custkey") % 3 == 0, "no").when(F.col("c_custkey") % 3 == 1, " Yes ").otherwise("да")
    rows = view(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("account_id"), F.concat(F.lit(" "), "c_name").alias("name"), F.lit(None).cast("string").alias("key"), F.concat(F.lit("Member "), "c_custkey").alias("display_name"), F.concat(F.lower("c_mktsegment"), F.lit("@example.org")).alias("email"), active.alias("active"))
    loading.write_tsv(rows, path)
    return loading.members(loading.read_tsv(spark, path), exclude=(" MACHIN ", ""))
