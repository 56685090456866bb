"""Stale chunks: the stream over shuffled files against the rule over the table."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import monitoring as m
from millrace.streaming import stale

START = datetime(2024, 1, 1)
SCHEMA = "chunk long, at timestamp, last boolean"


def spells(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("order", ["sorted", "shuffled"])
def test_stream_equals_the_rule_whatever_the_files_order(spark, tmp_path, order):
    rng = random.Random(7)
    rows = []
    for chunk in range(12):
        at = 0
        for _ in range(40):
            at += rng.choice([1, 5, 20, 60, 61, 300, 2000])
            rows.append((chunk, START + timedelta(seconds=at), rng.random() < 0.1 or None))
    rows += [(12, START + timedelta(seconds=s / 100), False) for s in range(3000)]  # dense: one chunk, many heartbeats
    rows += rows[:50] + [(None, START, False), (3, None, False)]
    rows += [(99, START + timedelta(days=30), False)]  # carries the watermark past the rest
    rows.sort(key=lambda r: r[1] or START)
    if order == "shuffled":
        rng.shuffle(rows)
    source = f"{tmp_path}/in"
    for i in range(6):
        spark.createDataFrame(rows[i::6] if order == "shuffled" else rows[i * len(rows) // 6 : (i + 1) * len(rows) // 6], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    late = 86400 * (20 if order == "shuffled" else 0)
    if order == "shuffled":  # disorder is covered only while the far heartbeat comes last
        spark.createDataFrame([r for r in rows if r[0] != 99], SCHEMA).coalesce(2).write.mode("overwrite").parquet(source)
        spark.createDataFrame([(99, START + timedelta(days=30), False)], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    table = spark.read.schema(SCHEMA).parquet(source)
    got = stale.stale_stream(spark, source, SCHEMA, "chunk", "at", F.col("last"), 60, late, f"{tmp_path}/out", f"{tmp_path}/state", files_per_batch=1)
    want = spells(stale.stale_spells(table, "chunk", "at", F.col("last"), 60, late))
    assert want and spells(got) == want
    again = stale.stale_stream(spark, source, SCHEMA, "chunk", "at", F.col("last"), 60, late, f"{tmp_path}/out", f"{tmp_path}/state")
    assert spells(again) == want  # a restart without new files adds nothing


def test_rule_over_edges(spark):
    t = lambda s: START + timedelta(seconds=s)
    rows = [(1, t(0), False), (1, t(60), False), (1, t(121), True), (2, t(0), True), (2, t(0), False), (3, t(900), None), (None, t(0), False)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [(c, a) for c, a, _ in spells(stale.stale_spells(df, "chunk", "at", F.col("last"), 60))] == [(1, t(60))]
    assert spells(stale.stale_spells(df.limit(0), "chunk", "at", F.col("last"), 60)) == []


def test_thinning_keeps_every_gap_under_later_arrivals():
    rng = np.random.default_rng(3)
    for _ in range(300):
        times, ended = rng.integers(0, 200, 30), rng.random(30) < 0.2
        later, late_ends = rng.integers(0, 200, 5), rng.random(5) < 0.2
        p = stale.StaleChunks(10)

        def gaps(x, e):
            x, e = stale.thinned(x, e, 10)
            return x[p._gaps(x, e)].tolist()

        def plain(x, e):
            byt = {}
            for a, b in zip(x.tolist(), e.tolist()):
                byt[a] = byt.get(a, False) or b
            keys = sorted(byt)
            return [a for a in keys if not byt[a] and not any(a < b <= a + 10 for b in keys)]

        x, e = stale.thinned(times, ended, 10)
        both = (np.concatenate([x, later]), np.concatenate([e, late_ends]))
        assert gaps(*both) == plain(np.concatenate([times, later]), np.concatenate([ended, late_ends]))


def test_stale_chunks_by_age(spark):
    rows = [(1, 1, "running", "w", "2024-01-01 00:00:00", None), (1, 2, "running", "w", None, "2024-01-01 00:50:00"), (1, 3, "completed", "w", None, "2023-01-01 00:00:00"), (1, 4, "writing", "w", None, None), (1, 5, "writing", "w", "2024-01-01 00:30:00", None)]
    df = spark.createDataFrame(rows, "run_id int, chunk_id int, status string, worker_id string, heartbeat_at string, started_at string")
    got = m.stale_chunks(df, F.lit("2024-01-01 01:00:00"), 30).collect()
    assert [(r["chunk_id"], r["age_minutes"]) for r in got] == [(1, 60.0)]


def test_a_group_has_one_timer_for_all_its_gaps():
    class Kept:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

        def clear(self):
            self.value = None

    class Handle:
        def __init__(self):
            self.timers = set()

        def getValueState(self, name, schema):
            return Kept()

        def registerTimer(self, at):
            self.timers.add(at)

    class At:
        def getCurrentWatermarkInMs(self):
            return 120

        def getExpiryTimeInMs(self):
            return 11

    handle, p = Handle(), stale.StaleChunks(10_000)
    p.init(handle)
    part = pd.DataFrame({"chunk_id": np.repeat([1, 2, 3], 10), "at_us": np.tile(np.arange(10) * 20_000, 3) + 1000, "ended": [False] * 30})
    assert list(p.handleInputRows((0,), iter([part]), At())) == [] and handle.timers == {11}
    out = pd.concat(p.handleExpiredTimer((0,), At(), At()))
    assert len(out) == 18 and handle.timers == {11, 131}  # six of ten gaps a chunk, in one call
