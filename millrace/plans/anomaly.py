"""Queries of the anomaly model. Trees are random, so only the feature matrix has an SQL twin."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.operators import anomaly as a
from millrace.operators.marts import binary_metrics
from millrace.plans import features
from millrace.plans.registry import query
from millrace.session import shared_dir, stored

EMPLOYEE = ["scan_interval", "scans_per_hour", "time_since_last_scan"]
ROUTE = ["error_rate", "picked_per_operation", "avg_waste_rate"]
ITEM = ["error_rate", "competitor_ratio", "route_count"]


def _matrix(df, key, cols):
    """The feature matrix in the shared folder: features are computed once, not anew for each pass of the model."""
    return stored(a.feature_matrix(df, key, cols), "matrix")


def _scored(df, key, cols, entity):
    matrix = _matrix(df, key, cols)
    return a.score_forest(matrix, a.fit_forest(matrix, cols), entity)


@query("ml1_feature_matrix", "SELECT employee_id AS entity_id, scan_interval, scans_per_hour, CAST(time_since_last_scan AS DOUBLE) AS time_since_last_scan FROM (" + features._HOURS + ")")
def ml1(spark, d):
    return a.feature_matrix(features.x01(spark, d), "employee_id", EMPLOYEE)


@query("ml2_standardized", "SELECT employee_id AS entity_id, round((scan_interval - m) / s, 6) AS scan_interval FROM (" + features._HOURS + "), (SELECT avg(scan_interval) AS m, stddev_pop(scan_interval) AS s FROM (" + features._HOURS + "))")
def ml2(spark, d):
    m = ml1(spark, d)
    mean, std = a.scales(m, ["scan_interval"])["scan_interval"]
    return m.select("entity_id", features.r6((F.col("scan_interval") - mean) / std).alias("scan_interval"))


@query("ml4_employee_anomalies")
def ml4(spark, d):
    return _scored(features.x01(spark, d), "employee_id", EMPLOYEE, "employee")


@query("ml4_route_anomalies")
def ml4r(spark, d):
    return _scored(features.x02(spark, d), "picking_route_id", ROUTE, "route")


@query("ml4_item_anomalies")
def ml4i(spark, d):
    return _scored(features.x03(spark, d), "item_id", ITEM, "item")


@query("ml5_model_metrics")
def ml5(spark, d):
    labels = features.x04(spark, d).select(F.col("employee_id").alias("entity_id"), "is_anomaly")
    return binary_metrics(ml4(spark, d).join(labels, "entity_id", "left").na.fill({"is_anomaly": 0}), "is_anomaly", "is_anomaly_predicted")


def _all(spark, d):
    pred = [f(spark, d).drop("feature_1", "feature_2", "feature_3") for f in (ml4, ml4r, ml4i)]
    return pred[0].unionByName(pred[1]).unionByName(pred[2])


@query("ml5_all_models")
def ml5_all(spark, d):
    labels = features.x04(spark, d).select(F.col("employee_id").alias("entity_id"), F.lit("employee").alias("entity_type"), "is_anomaly")
    return a.model_metrics(_all(spark, d), labels)


@query("ml4_predictions_table")
def ml4_table(spark, d):
    """Employees and routes scored by forests that were saved and loaded, appended to one table under one time."""
    folder = f"{shared_dir(spark)}/model-{uuid.uuid4().hex}"
    for df, key, cols, entity in ((features.x01(spark, d), "employee_id", EMPLOYEE, "employee"), (features.x02(spark, d), "picking_route_id", ROUTE, "route")):
        matrix = _matrix(df, key, cols)
        a.save_forest(spark, a.fit_forest(matrix, cols), f"{folder}/forest-{entity}")
        table = a.append_predictions(a.score_forest(matrix, a.load_forest(spark, f"{folder}/forest-{entity}"), entity), f"{folder}/predictions", "2024-01-01 00:00:00")
    return table


@query("ml6_anomaly_rates")
def ml6(spark, d):
    return a.anomaly_rates(_all(spark, d))
