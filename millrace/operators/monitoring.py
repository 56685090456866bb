"""Analysis of load history: progress, health, problems, speed and forecasts.

Every operator works on all runs at once, by run_id; `as_of` stands for the present, so results can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import r6, safe_div, seconds_between
from millrace.operators.selection import value_at
from millrace.operators.sweep import count_in_ranges

STATUSES = ("completed", "running", "ready_to_commit", "writing", "retry", "pending", "failed")
ACTIVE = ("running", "ready_to_commit", "writing")


def age(col: str, as_of: str) -> Column:
    return seconds_between(F.col(col), F.lit(as_of).cast("timestamp_ntz"))


def _n(*statuses: str) -> Column:
    return F.count_if(F.col("status").isin(*statuses))


def run_totals(chunks: DataFrame) -> DataFrame:
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows_read", "rows_inserted", "rows_conflicted")]
    return chunks.groupBy("run_id").agg(F.count("*").alias("total_chunks"), _n("completed").alias("completed_chunks"), _n(*ACTIVE).alias("active_chunks"), _n("retry").alias("retry_chunks"), _n("pending").alias("pending_chunks"), _n("failed").alias("failed_chunks"), *sums, F.coalesce(F.sum(F.when(F.col("status") == "completed", F.col("rows_read"))), F.lit(0)).alias("completed_rows"))


def run_passport(runs: DataFrame, totals: DataFrame, as_of: str) -> DataFrame:
    j = runs.join(totals, "run_id", "left")
    return j.select("run_id", "pipeline_name", seconds_between(F.col("started_at"), F.lit(as_of).cast("timestamp_ntz")).alias("elapsed_seconds"), r6(100 * safe_div(F.col("completed_chunks"), F.col("total_chunks"))).alias("completed_pct"))


def status_summary(chunks: DataFrame) -> DataFrame:
    """Chunks and share per status, over the whole list of statuses, seen or not."""
    per = chunks.groupBy("run_id").pivot("status", list(STATUSES)).agg(F.count(F.lit(1))).na.fill(0)
    rows = per.select("run_id", F.inline(F.array(*[F.struct(F.lit(s).alias("status"), F.col(s).alias("chunks")) for s in STATUSES])))
    return rows.withColumn("share", r6(100 * F.col("chunks") / F.sum("chunks").over(Window.partitionBy("run_id"))))


def progress(runs: DataFrame, chunks: DataFrame, as_of: str) -> DataFrame:
    t = run_totals(chunks).join(runs.select("run_id", "started_at", "declared_rows"), "run_id")
    t = t.withColumn("elapsed", age("started_at", as_of))
    speed = safe_div(F.col("completed_rows"), F.col("elapsed"))
    left = F.col("declared_rows") - F.col("completed_rows")
    return t.select("run_id", "total_chunks", "completed_chunks", "active_chunks", "completed_rows", r6(100 * safe_div(F.col("completed_chunks"), F.col("total_chunks"))).alias("chunk_pct"), r6(F.when(F.col("declared_rows") > 0, 100.0 * F.col("completed_rows") / F.col("declared_rows"))).alias("rows_pct"), r6(speed).alias("rows_per_second"), r6(F.when((F.col("elapsed") > 0) & (F.col("completed_rows") > 0) & (left > 0), left / speed)).alias("remaining_seconds"))


def heartbeat_health(chunks: DataFrame, as_of: str, interval: int = 30, timeout: int = 600) -> DataFrame:
    a = age("heartbeat_at", as_of)
    state = F.when(F.col("heartbeat_at").isNull(), "NO_HEARTBEAT").when(a > timeout, "STALE").when(a > 2 * interval, "WARNING").otherwise("OK")
    return chunks.where(F.col("status").isin(*ACTIVE)).select("run_id", "chunk_id", "status", "worker_id", r6(a).alias("heartbeat_age"), state.alias("health"))


def chunk_speed(chunks: DataFrame) -> DataFrame:
    done = chunks.where("status = 'completed'")
    return done.select("run_id", "chunk_id", "rows_read", r6("seconds").alias("seconds"), r6(F.when(F.col("seconds") > 0, F.col("rows_read") / F.col("seconds"))).alias("rows_per_second"))


def retry_queue(chunks: DataFrame, as_of: str) -> DataFrame:
    rank = F.when(F.col("status") == "failed", 1).when(F.col("status") == "retry", 2).otherwise(3)
    return chunks.where(F.col("status").isin("failed", "retry", "pending")).select("run_id", "chunk_id", "status", rank.alias("queue_rank"), "attempt_count", r6(age("updated_at", as_of)).alias("age"))


def problems(chunks: DataFrame, as_of: str, warn_min: float = 10, max_attempts: int = 5, timeout: int = 600) -> DataFrame:
    """Chunks that need attention with severity and the action to take; the first rule that holds decides."""
    beat, state = age("heartbeat_at", as_of), age("updated_at", as_of)
    is_ = lambda s: F.col("status") == s
    lost, late = F.col("heartbeat_at").isNull(), beat > timeout
    slow = state > 60 * warn_min
    rules = [
        (is_("failed"), "CRITICAL", "read the error and its cause"),
        (is_("running") & lost, "CRITICAL", "check the worker: no heartbeat"),
        (is_("running") & late, "CRITICAL", "check the worker, set the chunk to retry if it has stopped"),
        (is_("ready_to_commit") & slow, "WARNING", "check the writer and the staged rows"),
        (is_("writing") & slow, "CRITICAL", "check the transaction and its locks"),
        (F.col("attempt_count") >= max_attempts, "WARNING", "find why it is tried again"),
        (F.col("error_type").isNotNull(), "WARNING", "read the last error"),
    ]
    severity, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for cond, s, a in reversed(rules):
        severity, action = F.when(cond, s).otherwise(severity), F.when(cond, a).otherwise(action)
    return chunks.withColumns({"severity": severity, "action": action}).where("severity is not null").select("run_id", "chunk_id", "status", "attempt_count", "severity", "action")


def writer_backlog(chunks: DataFrame, as_of: str, warn_min: float = 10) -> DataFrame:
    a = age("updated_at", as_of)
    is_ = lambda s: F.col("status") == s
    slow = a > 60 * warn_min
    state = F.when(F.count_if(is_("writing") & slow) > 0, "CRITICAL").when(F.count_if(is_("ready_to_commit") & slow) > 0, "WARNING").when(_n("ready_to_commit") > 0, "INFO").otherwise("OK")
    return chunks.groupBy("run_id").agg(_n("running").alias("running"), _n("ready_to_commit").alias("ready"), _n("writing").alias("writing"), r6(F.max(F.when(is_("ready_to_commit"), a))).alias("oldest_ready"), r6(F.max(F.when(is_("writing"), a))).alias("oldest_writing"), state.alias("writer_status"))


def overall_verdict(chunks: DataFrame, as_of: str, warn_min: float = 10, timeout: int = 600) -> DataFrame:
    is_ = lambda s: F.col("status") == s
    slow = age("updated_at", as_of) > 60 * warn_min
    t = chunks.groupBy("run_id").agg(F.count("*").alias("total"), _n("completed").alias("completed"), _n("failed").alias("failed"), _n("retry").alias("retry"), F.count_if(is_("running") & (F.col("heartbeat_at").isNull() | (age("heartbeat_at", as_of) > timeout))).alias("stale"), F.count_if(is_("ready_to_commit") & slow).alias("stuck_ready"), F.count_if(is_("writing") & slow).alias("stuck_writing"))
    c = F.col
    verdict = F.when(c("completed") == c("total"), "COMPLETED").when((c("failed") > 0) | (c("stale") > 0) | (c("stuck_writing") > 0), "CRITICAL").when((c("retry") > 0) | (c("stuck_ready") > 0), "WARNING").otherwise("HEALTHY")
    why = F.when(c("completed") == c("total"), "all chunks completed").when(c("failed") > 0, "failed chunks").when(c("stale") > 0, "stale running chunks").when(c("stuck_writing") > 0, "chunks stuck in writing").when(c("stuck_ready") > 0, "chunks wait for the writer").when(c("retry") > 0, "chunks wait for a retry").otherwise("normal")
    return t.withColumns({"verdict": verdict, "diagnosis": why})


def speed_stats(speeds: DataFrame) -> DataFrame:
    """Speed per run: least, most, mean, median and chunks below 0.7 of the median."""
    s = speeds.groupBy("run_id").agg(F.min("rows_per_second").alias("least"), F.max("rows_per_second").alias("most"), r6(F.avg("rows_per_second")).alias("mean"), F.median("rows_per_second").alias("mid"))
    slow = speeds.join(s, "run_id").groupBy("run_id").agg(F.count_if(F.col("rows_per_second") < 0.7 * F.col("mid")).alias("slow_chunks"))
    return s.join(slow, "run_id").withColumn("mid", r6("mid"))


def worker_stats(chunks: DataFrame) -> DataFrame:
    done = F.col("status") == "completed"
    return chunks.groupBy("run_id", "worker_id").agg(F.count("*").alias("chunks"), F.coalesce(F.sum(F.when(done, F.col("rows_read"))), F.lit(0)).alias("rows"), r6(F.avg(F.when(done, F.col("seconds")))).alias("avg_seconds"), F.count("error_type").alias("errors"), F.sum("attempt_count").alias("attempts"), F.max("heartbeat_at").alias("last_heartbeat"))


def forecast(prog: DataFrame, chunks: DataFrame, workers: int = 4) -> DataFrame:
    """Remaining seconds by rows and by chunks over the workers, with a cautious (x 1.3) and a hopeful (x 0.8) view."""
    c = chunks.groupBy("run_id").agg(F.count_if(F.col("status") != "completed").alias("left"), F.avg(F.when(F.col("status") == "completed", F.col("seconds"))).alias("each"))
    by_chunks = F.col("left") * F.col("each") / workers
    return prog.select("run_id", F.col("remaining_seconds").alias("by_rows")).join(c, "run_id").select("run_id", "by_rows", r6(by_chunks).alias("by_chunks"), r6(by_chunks * 1.3).alias("cautious"), r6(by_chunks * 0.8).alias("hopeful"))


def range_continuity(chunks: DataFrame) -> DataFrame:
    prev = F.lag("range_end").over(Window.partitionBy("run_id").orderBy("chunk_no"))
    c = chunks.withColumn("previous_end", prev)
    state = F.when(F.col("range_start") >= F.col("range_end"), "INVALID_RANGE").when(F.col("previous_end") > F.col("range_start"), "OVERLAP").when(F.col("previous_end") != F.col("range_start"), "GAP").otherwise("OK")
    return c.select("run_id", "chunk_no", "range_start", "range_end", "previous_end", state.alias("range_status"))


def validate_chunks(chunks: DataFrame) -> DataFrame:
    expected = F.col("range_end") - F.col("range_start")
    state = F.when(F.col("rows_read") == 0, "EMPTY").when(F.col("rows_read") != expected, "READ_COUNT_MISMATCH").when(F.col("rows_inserted") != F.col("rows_read"), "METRICS_MISMATCH").otherwise("OK")
    return chunks.where("status = 'completed'").select("run_id", "chunk_no", "rows_read", expected.alias("expected_rows"), state.alias("validation"))


def validate_chunks_in_target(chunks: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Completed chunks with the rows that the target has in their range, and the first rule that they break.

    chunks: chunk_no, status, range_start, range_end (of any width, overlapping or not), rows_read, rows_inserted,
    rows_conflicted. Order of the rules: empty, read, metrics, target.
    """
    done = chunks.where("status = 'completed'")
    counted = count_in_ranges(done, target, key, ["chunk_no"], "range_start", "range_end").withColumnRenamed("rows", "rows_in_target")
    expected = F.col("range_end") - F.col("range_start")
    state = (
        F.when(F.col("rows_read") == 0, "EMPTY").when(F.col("rows_read") != expected, "READ_COUNT_MISMATCH").when(F.col("rows_inserted") + F.col("rows_conflicted") != F.col("rows_read"), "METRICS_MISMATCH")
        .when(F.col("rows_in_target") != expected, "TARGET_COUNT_MISMATCH").otherwise("OK")
    )
    return counted.withColumns({"expected_rows": expected, "validation": state})


def staging_check(staging: DataFrame, chunks: DataFrame) -> DataFrame:
    """Staged rows in all, of completed and failed chunks, and of chunks that the history does not know."""
    known = chunks.select("chunk_id", "status")
    j = staging.join(known, "chunk_id", "left")
    return j.agg(F.count("*").alias("total_rows"), F.countDistinct("chunk_id").alias("distinct_chunks"), _n("completed").alias("rows_for_completed"), _n("failed").alias("rows_for_failed"), F.count_if(F.col("status").isNull()).alias("orphan_rows"))


def nearest_rank(df: DataFrame, col: str, q: float, keys: list[str]) -> DataFrame:
    """The value at place floor(n*q) of the ascending values, counted from 0, per key."""
    w = Window.partitionBy(*keys)
    r = df.where(F.col(col).isNotNull()).withColumns({"_r": F.row_number().over(w.orderBy(col)), "_n": F.count("*").over(w)})
    return r.where(F.col("_r") == F.least(F.floor(F.col("_n") * q), F.col("_n") - 1) + 1).select(*keys, F.col(col).alias("value"))


def batch_metrics(chunks: DataFrame) -> DataFrame:
    """Per run: batches with a time, their mean and p95 seconds (nearest rank) and the rows a second over all of them."""
    timed = chunks.where("seconds is not null")
    sums = timed.groupBy("run_id").agg(F.count("*").alias("batches"), r6(F.avg("seconds")).alias("avg_seconds"), r6(safe_div(F.sum("rows_read"), F.sum("seconds"))).alias("rows_per_second"))
    return sums.join(value_at(timed, "seconds", 0.95, ["run_id"]).withColumnRenamed("value", "p95_seconds"), "run_id")


def batch_extremes(chunks: DataFrame) -> DataFrame:
    timed = F.when(F.col("seconds") > 0, F.struct("seconds", "chunk_id"))
    x = chunks.groupBy("run_id").agg(F.max(timed).alias("a"), F.min(timed).alias("b"), _n("failed").alias("failed"))
    return x.select("run_id", F.col("a.chunk_id").alias("slowest"), F.col("b.chunk_id").alias("fastest"), "failed")


def benchmark_summary(runs: DataFrame, by: str) -> DataFrame:
    return runs.groupBy(by).agg(F.count("*").alias("runs"), _n("completed").alias("successes"), r6(F.avg("seconds")).alias("avg_seconds"), r6(F.median("seconds")).alias("median_seconds"), r6(F.stddev_samp("seconds")).alias("std_seconds"), r6(F.median(F.col("rows_read") / F.nullif(F.col("seconds"), F.lit(0.0)))).alias("median_speed"))


def counter_rates(df: DataFrame, ts: str, col: str, key: str) -> DataFrame:
    """Change of a counter, minutes passed and rate per minute between rows of a key; 0 on its first row."""
    w = Window.partitionBy(key).orderBy(ts, col)
    minutes = seconds_between(F.lag(ts).over(w), F.col(ts)) / 60
    out = df.withColumns({"delta": F.coalesce(F.col(col) - F.lag(col).over(w), F.lit(0.0)), "minutes": F.coalesce(minutes, F.lit(0.0))})
    return out.withColumn("rate", r6(safe_div(F.col("delta"), F.col("minutes")))).withColumns({"delta": r6("delta"), "minutes": r6("minutes")})


def rate_status(rates: DataFrame, key: str, slow: float) -> DataFrame:
    """Shares of normal, slow and idle intervals per key, with a verdict."""
    n = rates.groupBy(key).agg(F.count("*").alias("n"), F.count_if(F.col("rate") > slow).alias("normal"), F.count_if((F.col("rate") > 0) & (F.col("rate") <= slow)).alias("slow"), F.count_if(F.col("rate") <= 0).alias("idle"))
    verdict = F.when(F.col("slow") > 0.5 * F.col("n"), "SLOW").when(F.col("idle") > 0.3 * F.col("n"), "INTERMITTENT").otherwise("NORMAL")
    return n.withColumn("verdict", verdict)


def time_to_target(rates: DataFrame, key: str, col: str, target: float) -> DataFrame:
    t = rates.groupBy(key).agg(F.max(col).alias("now"), F.avg(F.when(F.col("rate") > 0, F.col("rate"))).alias("mean_rate"))
    return t.select(key, r6(F.when(F.col("now") < target, (target - F.col("now")) / F.col("mean_rate")).otherwise(0.0)).alias("minutes_left"))


def compare_runs(totals: DataFrame, runs: DataFrame) -> DataFrame:
    """Each run against the one before of its pipeline: difference and percent (0 where the earlier was 0)."""
    w = Window.partitionBy("pipeline_name").orderBy("started_at", "run_id")
    j = totals.join(runs.select("run_id", "pipeline_name", "started_at"), "run_id").withColumn("previous", F.lag("rows_read").over(w))
    diff = F.col("rows_read") - F.col("previous")
    return j.where("previous is not null").select("run_id", "pipeline_name", "rows_read", "previous", diff.alias("diff"), r6(F.when(F.col("previous") != 0, 100.0 * diff / F.col("previous")).otherwise(0.0)).alias("pct"), F.when(diff > 0, "more").when(diff < 0, "fewer").otherwise("same").alias("assessment"))


def bottleneck(df: DataFrame, key: str, col: str) -> DataFrame:
    """The most frequent category per key; ties go to the name first in order."""
    n = df.groupBy(key, col).agg(F.count("*").alias("n"))
    return n.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), col))).where("_r = 1").drop("_r")


def run_success(totals: DataFrame) -> DataFrame:
    c = F.col
    return totals.select("run_id", ((c("total_chunks") > 0) & (c("completed_chunks") == c("total_chunks")) & (c("failed_chunks") == 0) & (c("rows_inserted") + c("rows_conflicted") == c("rows_read"))).alias("success"))


def resumable(chunks: DataFrame, max_attempts: int) -> DataFrame:
    return chunks.where(F.col("status").isin("pending", "failed", "retry") & (F.col("attempt_count") < max_attempts)).select("run_id", "chunk_id", "status", "attempt_count")


def stale_chunks(chunks: DataFrame, as_of: Column, minutes: float) -> DataFrame:
    """Chunks at work whose last heartbeat (without one: their start) is more than so many minutes old, with that age.

    A chunk with neither has an unknown age and is not stale.
    """
    seen = F.coalesce("heartbeat_at", "started_at").cast("timestamp")
    age = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(seen)) / 6e7
    rows = chunks.where(F.col("status").isin("running", "writing", "ready_to_commit")).withColumn("age_minutes", age)
    return rows.where(F.col("age_minutes") > minutes).select("run_id", "chunk_id", "status", "worker_id", "age_minutes")


def completed_chunks(chunks: DataFrame) -> DataFrame:
    """Completed chunks as they are exported: duration in seconds (null unless it ended after its start) and whole rows a second."""
    took = F.when(F.col("completed_at") > F.col("started_at"), seconds_between(F.col("started_at"), F.col("completed_at")))
    done = chunks.where("status = 'completed'").withColumn("duration_seconds", took)
    return done.select("run_id", "chunk_no", "status", "attempt_count", "rows_read", "rows_inserted", "rows_conflicted", "started_at", "completed_at", "duration_seconds", F.round(F.col("rows_read") / F.col("duration_seconds")).cast("long").alias("rows_per_second"))


def load_metrics(totals: DataFrame) -> DataFrame:
    """Totals as (run_id, metric, value) rows."""
    names = [c for c in totals.columns if c != "run_id"]
    return totals.select("run_id", F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])))
