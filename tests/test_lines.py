"""Lineage to its ends, rows in ranges, and open operations against plain Python."""

import datetime as dt
import random

import pytest
from millrace.operators import lineage, sweep
from millrace.operators.monitoring import validate_chunks_in_target
from pyspark.sql import functions as F


def plain_paths(edges):
    out, to = {}, {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            to.setdefault(a, set()).add(b)
    for root in to:
        front, depth, seen = {root}, 0, {root}
        while front:
            depth += 1
            front = {b for a in front for b in to.get(a, ())} - seen
            seen |= front
            out |= {(root, b): depth for b in front}
    return out


@pytest.mark.parametrize("edges", [
    [], [(1, 1), (None, 2), (2, None)], [(i, i + 1) for i in range(21)], [(i, (i + 1) % 7) for i in range(7)] * 2,
    [(0, i) for i in range(1, 30)] + [(i, 30) for i in range(1, 30)] + [(30, 0)], [(random.Random(i).randrange(25), random.Random(-i).randrange(25)) for i in range(40)],
])
def test_closure(spark, edges):
    got = lineage.closure(spark.createDataFrame(edges, "src long, dst long").withColumn("depth", F.lit("x"))).collect()
    assert {(r["src"], r["dst"]): r["depth"] for r in got} == plain_paths(edges) and len(got) == len(plain_paths(edges))


def shuffled_rows(spark):
    """Rows that all stages of the session have written for shuffles."""
    jvm, none = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(jvm.java.util.ArrayList(), False, False, none, jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_closure_shuffles_no_known_pair_again(spark, monkeypatch):
    edges = [(i, i // 3) for i in range(3000)] + [(i, i + 1) for i in range(1, 3000, 3)] + [(i, i - 1) for i in range(2, 3000, 3)]
    rows, want = spark.createDataFrame(edges, "src long, dst long"), plain_paths(edges)
    before = shuffled_rows(spark)
    got = {(r["src"], r["dst"]): r["depth"] for r in lineage.closure(rows).collect()}
    assert got == want and shuffled_rows(spark) - before < len(want)  # before, every round shuffled all pairs twice
    monkeypatch.setattr(lineage, "FEW", 0)  # no frontier is small
    assert {(r["src"], r["dst"]): r["depth"] for r in lineage.closure(rows).collect()} == want


def test_history_names_every_table_once_a_record(spark):
    rows = spark.createDataFrame([("a", "b", 1), ("b", "b", 2), (None, "a", 3)], "source string, target string, run long")
    got = {(r["node"], r["role"], r["run"]) for r in lineage.table_history(rows).collect()}
    assert got == {("a", "source", 1), ("b", "target", 1), ("b", "both", 2), ("a", "target", 3)}


def test_running_total_over_ties_and_partitions(spark):
    r = random.Random(1)
    rows = [(r.choice([1, 1, 1, 2, 5]), None if i % 9 == 0 else 2**60 + i, r.randrange(-3, 4)) for i in range(500)]
    got = sweep.running_total(spark.createDataFrame(rows, "k long, big long, v long").repartition(7), ["k"], "v").collect()
    assert sorted(((x["k"], x["big"], x["v"]) for x in got), key=str) == sorted(rows, key=str)
    for k in (1, 2, 5):  # the last of a key has the sum of all keys up to it
        assert sum(v for a, _, v in rows if a <= k) in [x["running"] for x in got if x["k"] == k]
    assert sweep.running_total(spark.createDataFrame([], "k long, v long"), ["k"], "v").count() == 0


def test_ranges_of_any_width(spark):
    r = random.Random(2)
    keys = [r.choice([None, 5, 5, 5, r.randrange(1000), 10**15]) for _ in range(300)]
    ranges = [(i, r.randrange(-5, 900), r.choice([0, 1, 7, 10**16])) for i in range(60)]
    ranges = [(i, lo, lo + w) for i, lo, w in ranges] + [(90, 8, 3), (91, None, 4), (92, 4, None), (None, 0, 10)]
    got = {x["n"]: x["rows"] for x in sweep.count_in_ranges(spark.createDataFrame(ranges, "n long, lo long, hi long"), spark.createDataFrame([(k,) for k in keys], "k long"), "k", ["n"]).collect()}
    assert got == {n: None if lo is None or hi is None else sum(k is not None and lo <= k < hi for k in keys) for n, lo, hi in ranges}


def test_verdict_order_of_chunks(spark):
    target = spark.createDataFrame([(k,) for k in range(0, 40)], "k long")
    chunks = [(1, "completed", 0, 10, 0, 5, 5), (2, "completed", 0, 10, 9, 1, 1), (3, "completed", 0, 10, 10, 9, 0), (4, "completed", 30, 50, 20, 20, 0), (5, "completed", 10, 20, 10, 8, 2), (6, "failed", 0, 10, 10, 10, 0)]
    df = spark.createDataFrame(chunks, "chunk_no long, status string, range_start long, range_end long, rows_read long, rows_inserted long, rows_conflicted long")
    got = {r["chunk_no"]: (r["validation"], r["rows_in_target"]) for r in validate_chunks_in_target(df, target, "k").collect()}
    assert got == {1: ("EMPTY", 10), 2: ("READ_COUNT_MISMATCH", 10), 3: ("METRICS_MISMATCH", 10), 4: ("TARGET_COUNT_MISMATCH", 10), 5: ("OK", 10)}


def test_open_levels_and_peaks(spark):
    t0, r = dt.datetime(2024, 1, 1, 22), random.Random(3)
    spans = [(t0 + dt.timedelta(minutes=30 * r.randrange(200)), r.choice([0, -30, 30, 60, 600, 4000])) for _ in range(80)]
    spans = [(s, s + dt.timedelta(minutes=m)) for s, m in spans] + [(t0, None)]
    levels = sweep.open_levels(spark.createDataFrame(spans, "s timestamp_ntz, e timestamp_ntz"), "s", "e")
    got = {x["moment"]: x["open"] for x in levels.collect()}
    real = [(s, e) for s, e in spans if e is not None and s < e]
    at = lambda t: sum(s <= t < e for s, e in real)
    assert got == {t: at(t) for span in real for t in span}
    peaks = {x["day"]: x["most_open"] for x in sweep.peaks_by_day(levels).collect()}
    midnight = lambda d: dt.datetime(d.year, d.month, d.day)
    assert peaks == {d: max(at(t) for t in [midnight(d), *[m for m in got if m.date() == d]]) for d in {m.date() for m in got}}
    long = sweep.long_running(spark.createDataFrame(spans, "s timestamp_ntz, e timestamp_ntz"), "s", "e", 3600, F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"))
    assert long.count() == sum((e - s).total_seconds() > 3600 for s, e in real) + 1
