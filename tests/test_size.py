"""What keeps a task's share of a large table small."""

from __future__ import annotations

import math

from millrace.operators import marts
from millrace.plans import anomaly
from millrace.sources import adapters


def test_describe_gathers_no_column_in_one_task(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, None), (4.0, 7), (4.0, 5), (None, 5)], "a double, b int")
    got = marts.describe(df, ["a", "b"])
    assert "percentile" not in got._jdf.queryExecution().toString().lower()
    rows = {r["column"]: r for r in got.collect()}
    assert [rows["a"][c] for c in ("count", "min", "q25", "q50", "q75", "max")] == [4, 1.0, 1.75, 3.0, 4.0, 4.0]
    assert [rows["b"][c] for c in ("count", "q25", "q50", "q75")] == [4, 5.0, 5.0, 5.5]
    none = marts.describe(df.where("a > 9"), ["a"]).first()
    assert none["count"] == 0 and none["q50"] is None and none["mean"] is None
    odd = marts.describe(spark.createDataFrame([(float("inf"),), (float("nan"),), (1.0,)], "a double"), ["a"]).first()
    assert odd["q50"] == float("inf") and math.isnan(odd["max"])


def test_rows_of_a_view_with_a_group_per_row_are_dealt_by_number(spark, sf):
    rows = spark.range(1000)
    assert adapters.dealt(rows, ["id"], rows=50).rdd.getNumPartitions() == 20
    assert "REPARTITION_BY_NUM" in adapters.view(spark, sf, "picking")._jdf.queryExecution().toString()


def test_features_are_computed_once_for_a_model(spark):
    matrix = anomaly._matrix(spark.createDataFrame([(1, 2.0), (2, None)], "k int, a double"), "k", ["a"])
    assert matrix.inputFiles() and all("/matrix-" in f for f in matrix.inputFiles())
    assert sorted(tuple(r) for r in matrix.collect()) == [("1", 2.0), ("2", 0.0)]
