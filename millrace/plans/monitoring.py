"""Queries of the load history."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.functions.columns import r6
from millrace.operators import monitoring as m
from millrace.plans.registry import query
from millrace.session import shared_dir
from millrace.sources.adapters import view
from millrace.streaming import stale

AS_OF = "2024-01-30 12:00:00"
_AGE = f"(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us({{0}})) / 1e6"
_BEAT, _UPD = _AGE.format("heartbeat_at"), _AGE.format("updated_at")
_TOTALS = """
SELECT run_id, count(*) AS total_chunks, count_if(status = 'completed') AS completed_chunks, count_if(status IN ('running', 'ready_to_commit', 'writing')) AS active_chunks,
       count_if(status = 'retry') AS retry_chunks, count_if(status = 'pending') AS pending_chunks, count_if(status = 'failed') AS failed_chunks,
       CAST(sum(rows_read) AS BIGINT) AS rows_read, CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted, CAST(sum(rows_conflicted) AS BIGINT) AS rows_conflicted,
       CAST(coalesce(sum(rows_read) FILTER (status = 'completed'), 0) AS BIGINT) AS completed_rows
FROM {load_chunk} GROUP BY run_id"""


def _chunks(spark, d):
    return view(spark, d, "load_chunk")


@query("a17_run_totals", _TOTALS)
def a17(spark, d):
    return m.run_totals(_chunks(spark, d))


@query("m01_run_passport", f"SELECT r.run_id, pipeline_name, {_AGE.format('r.started_at')} AS elapsed_seconds, round(100.0 * completed_chunks / total_chunks, 6) AS completed_pct FROM {{load_run}} r JOIN ({_TOTALS}) t ON t.run_id = r.run_id")
def m01(spark, d):
    return m.run_passport(view(spark, d, "load_run"), a17(spark, d), AS_OF)


@query("m02_status_summary", "SELECT r.run_id, s.status, count(c.chunk_id) AS chunks, round(100.0 * count(c.chunk_id) / any_value(r.n), 6) AS share FROM (SELECT run_id, count(*) AS n FROM {load_chunk} GROUP BY run_id) r, (SELECT unnest(['completed', 'running', 'ready_to_commit', 'writing', 'retry', 'pending', 'failed']) AS status) s LEFT JOIN {load_chunk} c ON c.run_id = r.run_id AND c.status = s.status GROUP BY r.run_id, s.status")
def m02(spark, d):
    return m.status_summary(_chunks(spark, d))


_PROGRESS = f"""
SELECT t.run_id, total_chunks, completed_chunks, active_chunks, completed_rows, round(100.0 * completed_chunks / total_chunks, 6) AS chunk_pct,
       round(CASE WHEN declared_rows > 0 THEN 100.0 * completed_rows / declared_rows END, 6) AS rows_pct,
       round(CASE WHEN e > 0 THEN completed_rows / e ELSE 0 END, 6) AS rows_per_second,
       round(CASE WHEN e > 0 AND completed_rows > 0 AND declared_rows > completed_rows THEN (declared_rows - completed_rows) / (completed_rows / e) END, 6) AS remaining_seconds
FROM ({_TOTALS}) t JOIN (SELECT run_id, declared_rows, {_AGE.format('started_at')} AS e FROM {{load_run}}) r ON r.run_id = t.run_id"""


@query("m03_progress", _PROGRESS)
def m03(spark, d):
    return m.progress(view(spark, d, "load_run"), _chunks(spark, d), AS_OF)


@query("m05_heartbeat_health", f"""
SELECT run_id, chunk_id, status, worker_id, round({_BEAT}, 6) AS heartbeat_age,
       CASE WHEN heartbeat_at IS NULL THEN 'NO_HEARTBEAT' WHEN {_BEAT} > 864000 THEN 'STALE' WHEN {_BEAT} > 172800 THEN 'WARNING' ELSE 'OK' END AS health
FROM {{load_chunk}} WHERE status IN ('running', 'ready_to_commit', 'writing')""")
def m05(spark, d):
    return m.heartbeat_health(_chunks(spark, d), AS_OF, 86400, 864000)


_SPEED = "SELECT run_id, chunk_id, rows_read, round(seconds, 6) AS seconds, round(CASE WHEN seconds > 0 THEN rows_read / seconds END, 6) AS rows_per_second FROM {load_chunk} WHERE status = 'completed'"


@query("m06_chunk_speed", _SPEED)
def m06(spark, d):
    return m.chunk_speed(_chunks(spark, d))


@query("m07_retry_queue", f"SELECT run_id, chunk_id, status, CASE status WHEN 'failed' THEN 1 WHEN 'retry' THEN 2 ELSE 3 END AS queue_rank, attempt_count, round({_UPD}, 6) AS age FROM {{load_chunk}} WHERE status IN ('failed', 'retry', 'pending')")
def m07(spark, d):
    return m.retry_queue(_chunks(spark, d), AS_OF)


@query("m08_problems", f"""
SELECT * FROM (SELECT run_id, chunk_id, status, attempt_count,
  CASE WHEN status = 'failed' OR (status = 'running' AND (heartbeat_at IS NULL OR {_BEAT} > 600)) THEN 'CRITICAL' WHEN status = 'ready_to_commit' AND {_UPD} > 600 THEN 'WARNING'
       WHEN status = 'writing' AND {_UPD} > 600 THEN 'CRITICAL' WHEN attempt_count >= 5 OR error_type IS NOT NULL THEN 'WARNING' END AS severity,
  CASE WHEN status = 'failed' THEN 'read the error and its cause' WHEN status = 'running' AND heartbeat_at IS NULL THEN 'check the worker: no heartbeat'
       WHEN status = 'running' AND {_BEAT} > 600 THEN 'check the worker, set the chunk to retry if it has stopped' WHEN status = 'ready_to_commit' AND {_UPD} > 600 THEN 'check the writer and the staged rows'
       WHEN status = 'writing' AND {_UPD} > 600 THEN 'check the transaction and its locks' WHEN attempt_count >= 5 THEN 'find why it is tried again' WHEN error_type IS NOT NULL THEN 'read the last error' END AS action
  FROM {{load_chunk}}) WHERE severity IS NOT NULL""")
def m08(spark, d):
    return m.problems(_chunks(spark, d), AS_OF)


@query("m09_writer_backlog", f"""
SELECT run_id, count_if(status = 'running') AS running, count_if(status = 'ready_to_commit') AS ready, count_if(status = 'writing') AS writing,
       round(max({_UPD}) FILTER (status = 'ready_to_commit'), 6) AS oldest_ready, round(max({_UPD}) FILTER (status = 'writing'), 6) AS oldest_writing,
       CASE WHEN count_if(status = 'writing' AND {_UPD} > 86400) > 0 THEN 'CRITICAL' WHEN count_if(status = 'ready_to_commit' AND {_UPD} > 86400) > 0 THEN 'WARNING'
            WHEN count_if(status = 'ready_to_commit') > 0 THEN 'INFO' ELSE 'OK' END AS writer_status
FROM {{load_chunk}} GROUP BY run_id""")
def m09(spark, d):
    return m.writer_backlog(_chunks(spark, d), AS_OF, 1440)


@query("m10_overall_verdict", f"""
SELECT *, CASE WHEN completed = total THEN 'COMPLETED' WHEN failed > 0 OR stale > 0 OR stuck_writing > 0 THEN 'CRITICAL' WHEN retry > 0 OR stuck_ready > 0 THEN 'WARNING' ELSE 'HEALTHY' END AS verdict,
       CASE WHEN completed = total THEN 'all chunks completed' WHEN failed > 0 THEN 'failed chunks' WHEN stale > 0 THEN 'stale running chunks' WHEN stuck_writing > 0 THEN 'chunks stuck in writing'
            WHEN stuck_ready > 0 THEN 'chunks wait for the writer' WHEN retry > 0 THEN 'chunks wait for a retry' ELSE 'normal' END AS diagnosis
FROM (SELECT run_id, count(*) AS total, count_if(status = 'completed') AS completed, count_if(status = 'failed') AS failed, count_if(status = 'retry') AS retry,
             count_if(status = 'running' AND (heartbeat_at IS NULL OR {_BEAT} > 600)) AS stale, count_if(status = 'ready_to_commit' AND {_UPD} > 600) AS stuck_ready,
             count_if(status = 'writing' AND {_UPD} > 600) AS stuck_writing FROM {{load_chunk}} GROUP BY run_id)""")
def m10(spark, d):
    return m.overall_verdict(_chunks(spark, d), AS_OF)


@query("m11_speed_stats", f"""
SELECT s.run_id, min(rows_per_second) AS least, max(rows_per_second) AS most, round(avg(rows_per_second), 6) AS mean, round(any_value(q.mid), 6) AS mid, count_if(rows_per_second < 0.7 * q.mid) AS slow_chunks
FROM ({_SPEED}) s JOIN (SELECT run_id, median(rows_per_second) AS mid FROM ({_SPEED}) GROUP BY run_id) q ON q.run_id = s.run_id GROUP BY s.run_id""")
def m11(spark, d):
    return m.speed_stats(m06(spark, d))


@query("m12_worker_stats", "SELECT run_id, worker_id, count(*) AS chunks, CAST(coalesce(sum(rows_read) FILTER (status = 'completed'), 0) AS BIGINT) AS rows, round(avg(seconds) FILTER (status = 'completed'), 6) AS avg_seconds, count(error_type) AS errors, CAST(sum(attempt_count) AS BIGINT) AS attempts, max(heartbeat_at) AS last_heartbeat FROM {load_chunk} GROUP BY run_id, worker_id")
def m12(spark, d):
    return m.worker_stats(_chunks(spark, d))


@query("m13_forecast", f"""
SELECT p.run_id, p.remaining_seconds AS by_rows, round(l * e / 4, 6) AS by_chunks, round(l * e / 4 * 1.3, 6) AS cautious, round(l * e / 4 * 0.8, 6) AS hopeful
FROM ({_PROGRESS}) p JOIN (SELECT run_id, count_if(status <> 'completed') AS l, avg(seconds) FILTER (status = 'completed') AS e FROM {{load_chunk}} GROUP BY run_id) c ON c.run_id = p.run_id""")
def m13(spark, d):
    return m.forecast(m03(spark, d), _chunks(spark, d))


@query("w02_range_continuity", """
SELECT run_id, chunk_no, range_start, range_end, previous_end, CASE WHEN range_start >= range_end THEN 'INVALID_RANGE' WHEN previous_end > range_start THEN 'OVERLAP' WHEN previous_end <> range_start THEN 'GAP' ELSE 'OK' END AS range_status
FROM (SELECT *, lag(range_end) OVER (PARTITION BY run_id ORDER BY chunk_no) AS previous_end FROM {chunk_range})""")
def w02(spark, d):
    return m.range_continuity(view(spark, d, "chunk_range"))


@query("q10_validate_chunks", """
SELECT run_id, chunk_no, rows_read, range_end - range_start AS expected_rows, CASE WHEN rows_read = 0 THEN 'EMPTY' WHEN rows_read <> range_end - range_start THEN 'READ_COUNT_MISMATCH' WHEN rows_inserted <> rows_read THEN 'METRICS_MISMATCH' ELSE 'OK' END AS validation
FROM {chunk_range} WHERE status = 'completed'""")
def q10(spark, d):
    return m.validate_chunks(view(spark, d, "chunk_range"))


@query("q11_staging_check", """
SELECT count(*) AS total_rows, count(DISTINCT l_orderkey) AS distinct_chunks, count_if(status = 'completed') AS rows_for_completed, count_if(status = 'failed') AS rows_for_failed, count_if(status IS NULL) AS orphan_rows
FROM lineitem LEFT JOIN {load_chunk} ON chunk_id = l_orderkey""")
def q11(spark, d):
    return m.staging_check(view(spark, d, "lineitem").select(F.col("l_orderkey").alias("chunk_id")), _chunks(spark, d))


@query("a19_nearest_rank_p95", "SELECT run_id, value FROM (SELECT run_id, seconds AS value, row_number() OVER (PARTITION BY run_id ORDER BY seconds) AS r, count(*) OVER (PARTITION BY run_id) AS n FROM {load_chunk}) WHERE r = least(floor(n * 0.95), n - 1) + 1")
def a19(spark, d):
    return m.nearest_rank(_chunks(spark, d), "seconds", 0.95, ["run_id"])


@query("a20_batch_extremes", "SELECT run_id, arg_max(chunk_id, (seconds, chunk_id)) FILTER (seconds > 0) AS slowest, arg_min(chunk_id, (seconds, chunk_id)) FILTER (seconds > 0) AS fastest, count_if(status = 'failed') AS failed FROM {load_chunk} GROUP BY run_id")
def a20(spark, d):
    return m.batch_extremes(_chunks(spark, d))


@query("a18_benchmark_summary", "SELECT worker_id, count(*) AS runs, count_if(status = 'completed') AS successes, round(avg(seconds), 6) AS avg_seconds, round(median(seconds), 6) AS median_seconds, round(stddev_samp(seconds), 6) AS std_seconds, round(median(rows_read / nullif(seconds, 0)), 6) AS median_speed FROM {load_chunk} GROUP BY worker_id")
def a18(spark, d):
    return m.benchmark_summary(_chunks(spark, d), "worker_id")


_RATES = """
SELECT user_id, event_id, ts, total, round(delta, 6) AS delta, round(minutes, 6) AS minutes, round(CASE WHEN minutes > 0 THEN delta / minutes ELSE 0 END, 6) AS rate
FROM (SELECT *, coalesce(total - lag(total) OVER w, 0) AS delta, coalesce((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 6e7, 0) AS minutes
      FROM (SELECT user_id, event_id, ts, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS DOUBLE) AS total FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, total))"""


@query("w06_counter_rates", _RATES)
def w06(spark, d):
    e = view(spark, d, "events").selectExpr("user_id", "event_id", "ts", "CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS DOUBLE) AS total")
    return m.counter_rates(e, "ts", "total", "user_id")


@query("m19_rate_status", f"SELECT *, CASE WHEN slow > 0.5 * n THEN 'SLOW' WHEN idle > 0.3 * n THEN 'INTERMITTENT' ELSE 'NORMAL' END AS verdict FROM (SELECT user_id, count(*) AS n, count_if(rate > 10) AS normal, count_if(rate > 0 AND rate <= 10) AS slow, count_if(rate <= 0) AS idle FROM ({_RATES}) GROUP BY user_id)")
def m19(spark, d):
    return m.rate_status(w06(spark, d), "user_id", 10)


@query("m20_time_to_target", f"SELECT user_id, round(CASE WHEN max(total) < 1e7 THEN (1e7 - max(total)) / avg(rate) FILTER (rate > 0) ELSE 0 END, 6) AS minutes_left FROM ({_RATES}) GROUP BY user_id")
def m20(spark, d):
    return m.time_to_target(w06(spark, d), "user_id", "total", 1e7)


@query("m17_compare_runs", f"""
SELECT run_id, pipeline_name, rows_read, previous, rows_read - previous AS diff, round(CASE WHEN previous <> 0 THEN 100.0 * (rows_read - previous) / previous ELSE 0 END, 6) AS pct,
       CASE WHEN rows_read > previous THEN 'more' WHEN rows_read < previous THEN 'fewer' ELSE 'same' END AS assessment
FROM (SELECT t.run_id, pipeline_name, rows_read, lag(rows_read) OVER (PARTITION BY pipeline_name ORDER BY started_at, t.run_id) AS previous FROM ({_TOTALS}) t JOIN {{load_run}} r ON r.run_id = t.run_id) WHERE previous IS NOT NULL""")
def m17(spark, d):
    return m.compare_runs(a17(spark, d), view(spark, d, "load_run"))


@query("m18_load_metrics", f"SELECT run_id, metric, value FROM (UNPIVOT (SELECT run_id, CAST(COLUMNS(* EXCLUDE run_id) AS DOUBLE) FROM ({_TOTALS})) ON COLUMNS(* EXCLUDE run_id) INTO NAME metric VALUE value)")
def m18(spark, d):
    return m.load_metrics(a17(spark, d))


@query("m21_bottleneck", "SELECT run_id, status, n FROM (SELECT run_id, status, count(*) AS n, row_number() OVER (PARTITION BY run_id ORDER BY count(*) DESC, status) AS r FROM {load_chunk} GROUP BY run_id, status) WHERE r = 1")
def m21(spark, d):
    return m.bottleneck(_chunks(spark, d), "run_id", "status")


@query("m24_run_success", f"SELECT run_id, completed_chunks = total_chunks AND failed_chunks = 0 AND rows_inserted + rows_conflicted = rows_read AS success FROM ({_TOTALS})")
def m24(spark, d):
    return m.run_success(a17(spark, d))


@query("i06_resumable_chunks", "SELECT run_id, chunk_id, status, attempt_count FROM {load_chunk} WHERE status IN ('pending', 'failed', 'retry') AND attempt_count < 3")
def i06(spark, d):
    return m.resumable(_chunks(spark, d), 3)


@query("i06_stale_chunks", """
SELECT run_id, chunk_id, status, worker_id, round((epoch_us(TIMESTAMP '2024-01-30') - epoch_us(coalesce(heartbeat_at, started_at))) / 6e7, 6) AS age_minutes
FROM {load_chunk} WHERE status IN ('running', 'writing', 'ready_to_commit') AND epoch_us(TIMESTAMP '2024-01-30') - epoch_us(coalesce(heartbeat_at, started_at)) > 600 * 6e7""")
def i06_stale(spark, d):
    return m.stale_chunks(_chunks(spark, d), F.lit("2024-01-30"), 600).withColumn("age_minutes", r6("age_minutes"))


# A run's events as its heartbeats: six hours without one are a stale spell, a purchase ends the run.
_SPELLS = """
SELECT chunk_id, beat AS last_heartbeat, beat + INTERVAL 6 HOUR AS stale_at
FROM (SELECT *, lead(beat) OVER (PARTITION BY chunk_id ORDER BY beat) AS following, max(beat) OVER () AS latest
      FROM (SELECT user_id AS chunk_id, ts AS beat, bool_or(event_type = 'purchase') AS ended FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2))
WHERE NOT ended AND (following IS NULL OR following > beat + INTERVAL 6 HOUR) AND beat + INTERVAL 6 HOUR <= date_trunc('milliseconds', latest) - INTERVAL {late} DAY"""


def _plain(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("last_heartbeat", "stale_at")})


@query("i06_stale_spells", _SPELLS.replace("{late}", "0"))
def i06_spells(spark, d):
    return _plain(stale.stale_spells(view(spark, d, "events"), "user_id", "ts", F.col("event_type") == "purchase", 6 * 3600))


@query("i06_stale_stream", _SPELLS.replace("{late}", "1"))
def i06_stream(spark, d):
    # the path as a glob, since a stream takes no path of a single file
    root, rows = f"{shared_dir(spark)}/stale-{uuid.uuid4().hex}", view(spark, d, "events")
    out = stale.stale_stream(spark, f"{d}/events.parque[t]", rows.schema, "user_id", "ts", F.col("event_type") == "purchase", 6 * 3600, 86400, f"{root}/spells", f"{root}/state")
    return _plain(out)
