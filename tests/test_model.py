"""Column profiles and the isolation forest: brute force, partitioning, save and load, odd rows."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from millrace.operators import anomaly as a
from millrace.operators.profile import column_profile, columns_to_load
from millrace.operators.selection import quantile


def test_profile_equals_brute_force_under_any_partitioning(spark):
    rows = [(f" v{i % 3000} ", None if i % 50 else "x", "same" if i % 2 else " ", None, str(i % 7)) for i in range(5000)]
    cols = ["many", "rare", "one", "void", "some"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    shapes = [{r["column"]: r for r in column_profile(x, cols).collect()} for x in (df.repartition(7), df.coalesce(1))]
    assert shapes[0] == shapes[1]
    for i, c in enumerate(cols):
        values = [r[i].strip() for r in rows if r[i] and r[i].strip()]
        got, lowest = shapes[0][c], sorted(set(values), key=lambda v: hashlib.md5(v.encode()).hexdigest())
        assert (got["total"], got["non_blank"], got["samples"]) == (5000, len(values), lowest[:5])
        assert got["exact"] == (len(lowest) < 1024) and abs(got["distinct_values"] - len(lowest)) <= 0.15 * len(lowest) * (not got["exact"])
    assert {c: r["decision"] for c, r in shapes[0].items()} == {"many": "keep", "rare": "empty", "one": "empty", "void": "empty", "some": "keep"}
    assert {r["column"] for r in columns_to_load(column_profile(df, cols)).collect()} == {"many", "some"}


def test_profile_of_an_empty_table_and_clashing_names(spark):
    got = column_profile(spark.createDataFrame([], "place string, `0` int"), ["place", "0"]).collect()
    assert sorted((r["column"], r["total"], r["distinct_values"], r["samples"], r["decision"]) for r in got) == [("0", 0, 0, [], "keep"), ("place", 0, 0, [], "keep")]


def test_quantile_is_linear_between_ranks(spark):
    for values in ([3.0], [1.0, 1.0, 1.0, 9.0], [float(i * i % 97) for i in range(500)]):
        df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
        for q in (0.1, 1.0):
            assert abs(quantile(df, "x", q) - np.quantile(values, q)) < 1e-9
    assert quantile(df.limit(0), "x", 0.5) == 0.0


def test_rows_enter_trees_as_often_as_asked(spark):
    m = a.feature_matrix(spark.range(20_000).select("id", F.rand(1).alias("x")), "id", ["x"])
    entered = {r["tree"]: r["count"] for r in a.drawn_rows(m, ["x"], 50, 0.03, 7).groupBy("tree").count().collect()}
    n = np.array([entered[t] for t in range(50)])  # binomial: mean 600, deviation 24
    assert abs(n.mean() - 600) < 15 and 15 < n.std() < 35
    assert a.drawn_rows(m.limit(3), ["x"], 50, 1.0, 7).count() == 150


def test_saved_forest_scores_alike_and_predictions_are_appended(spark, tmp_path):
    m = a.feature_matrix(spark.range(3000).select("id", (F.col("id") % 7).alias("x"), F.when(F.col("id") % 100 == 0, 50).otherwise(0).alias("y")), "id", ["x", "y"])
    forest = a.fit_forest(m, ["x", "y"], trees=20)
    a.save_forest(spark, forest, str(tmp_path / "forest"))
    one, two = (sorted(a.score_forest(m.repartition(n), f, "route", 0.01).collect()) for n, f in ((1, forest), (5, a.load_forest(spark, str(tmp_path / "forest")))))
    assert one == two and {r["entity_id"] for r in one if r["is_anomaly_predicted"]} <= {str(i) for i in range(0, 3000, 100)}
    pred, path = a.score_forest(m, forest, "route"), str(tmp_path / "predictions")
    for at in ("2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-02 00:00:00"):
        table = a.append_predictions(pred, path, at)
    assert table.groupBy("created_at").count().select("count").collect() == [(3000,), (3000,)] and table.schema["created_at"].dataType.typeName() == "timestamp"
    empty = a.fit_forest(m.limit(0), ["x", "y"])
    a.save_forest(spark, empty, str(tmp_path / "none"))
    assert a.score_forest(m.limit(0), a.load_forest(spark, str(tmp_path / "none")), "route").count() == 0


def test_metrics_by_type(spark):
    pred = spark.createDataFrame([("1", "employee", 1), ("2", "employee", 0), ("3", "employee", 1), ("1", "route", 1)], "entity_id string, entity_type string, is_anomaly_predicted int")
    labels = spark.createDataFrame([("1", "employee", 1), ("1", "employee", 0), ("2", "employee", 1), ("9", "employee", 1)], "entity_id string, entity_type string, is_anomaly int")
    got = {r["entity_type"]: tuple(r)[1:] for r in a.model_metrics(pred, labels).collect()}
    assert got == {"employee": (3, 2, 0.5, 0.5, 0.5), "route": (1, 1, 0.0, 0.0, 0.0)}
    assert {tuple(r)[3:] for r in a.model_metrics(pred).collect()} == {(0.0, 0.0, 0.0)}
