"""Refreshed summaries against recomputation after every change set."""

import random
import uuid

import pytest
from millrace.operators.refresh import MaterializedView, Summary, changes
from millrace.session import shared_dir

COLS = "k string, j long, x double, v long, day string"


def plain(rows):
    groups = {}
    for k, j, x, v, day in rows:
        groups.setdefault((k, j), []).append((x, v, day))
    out = []
    for key, own in groups.items():
        xs, vs, days = ([r[i] for r in own if r[i] is not None] for i in range(3))
        out.append((*key, len(own), round(sum(xs), 6) if xs else None, len(set(vs)), min(days, default=None), max(days, default=None)))
    return sorted(out, key=str)


def view_of(spark, buckets):
    return MaterializedView(spark, f"{shared_dir(spark)}/view-{uuid.uuid4().hex}", Summary(keys=("k", "j"), sums=("x",), distincts=("v",), extremes=("day",)), buckets)


def groups(view, like):
    return sorted(((r["k"], r["j"], r["row_count"], None if r["x_sum"] is None else round(r["x_sum"], 6), r["v_distinct"], r["day_min"], r["day_max"]) for r in view.read(like).collect()), key=str)


@pytest.mark.parametrize("buckets", [1, 5])
def test_equals_recomputation(spark, buckets):
    r = random.Random(buckets)
    new = lambda: (r.choice(["a", "b", "c", None]), r.choice([1, 2, None]), r.choice([0.5, 1.25, None]), r.choice([1, 2, 3, None]), r.choice(["d1", "d2", "d3", None]))
    df = lambda rows: spark.createDataFrame(rows, COLS)
    view, rows = view_of(spark, buckets), [new() for _ in range(40)]
    assert view.version == 0 and view.read(df([])).count() == 0
    assert view.refresh("load", changes(None, df(rows)))
    assert groups(view, df([])) == plain(rows)
    for step in range(2):
        gone, fresh = rows[:15], [new() for _ in range(8)]
        moved = [new() for _ in gone[:7]]  # seven updates, eight deletes, eight inserts
        batch = changes(df(gone), df(moved + fresh))
        rows = rows[15:] + moved + fresh
        assert view.refresh(f"step {step}", batch) and not view.refresh(f"step {step}", batch)
        assert groups(view, df([])) == plain(rows)
    assert view.refresh("all gone", changes(df(rows), None)) and groups(view, df([])) == []
    assert view.version == 4


def test_rows_that_are_not_there_end_with_an_error(spark):
    view, row = view_of(spark, 2), spark.createDataFrame([("a", 1, 1.0, 1, "d")], COLS)
    view.refresh("load", changes(None, row))
    with pytest.raises(ValueError):
        view.refresh("twice", changes(row.unionAll(row), None))
    with pytest.raises(ValueError):  # the group has a row, but none of this value
        view.refresh("other", changes(row.withColumnRenamed("v", "w").selectExpr("k", "j", "x", "w + 1 AS v", "day"), None))
    assert view.version == 1 and groups(view, row) == [("a", 1, 1, 1.0, 1, "d", "d")]


def test_second_writer_fails_and_untouched_buckets_stay(spark):
    view = view_of(spark, 8)
    row = lambda k: spark.createDataFrame([(k, 1, 1.0, 1, "d")], COLS)
    view.refresh("a", changes(None, row("a")))
    before = view._manifest()
    view.refresh("b", changes(None, row("b")))
    with pytest.raises(RuntimeError):
        view._commit({**before, "version": 2})
    after = view._manifest()["buckets"]
    assert all(after[b] == v for b, v in before["buckets"].items()) and len(after) == 2


def test_buckets_grow_with_the_first_load(spark, monkeypatch):
    from millrace.operators import refresh

    monkeypatch.setattr(refresh, "ROWS", 10, raising=False)
    rows = [(f"k{i % 100}", 1, 1.0, i % 7, "d") for i in range(400)]
    load = spark.createDataFrame(rows, COLS)
    view = view_of(spark, None)
    view.refresh("load", changes(None, load))
    again = MaterializedView(spark, view.path, view.summary)  # reads the number from the manifest
    again.refresh("less", changes(load.limit(0), spark.createDataFrame(rows[:3], COLS)))
    assert len(again._manifest()["buckets"]) > refresh.BUCKETS and groups(again, load) == plain(rows + rows[:3])
