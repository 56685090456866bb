"""Isolation forest: trees grown in parallel on hashed samples, rows scored by broadcast trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.columns import r6, safe_div
from millrace.operators.selection import quantile
from millrace.session import stored


@dataclass
class Forest:
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # per tree: split column (-1: leaf), split value or path length, right child
    sample: int
    cols: list[str]
    scale: dict[str, tuple[float, float]]


def feature_matrix(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """key and the columns as doubles; null, NaN and infinite become 0. Fitting and scoring read it several times: store it first."""
    fine = lambda c: F.when(F.isnan(c) | (F.abs(c) == float("inf")), 0.0).otherwise(c)
    return df.select(F.col(key).cast("string").alias("entity_id"), *[F.coalesce(fine(F.col(c).cast("double")), F.lit(0.0)).alias(c) for c in cols])


def scales(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation (1 where it is 0) of each column, in one pass."""
    r = df.agg(*[x for c in cols for x in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]).first()
    return {c: (r[f"m_{c}"] or 0.0, r[f"s_{c}"] or 1.0) for c in cols}


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n keys."""
    n = np.asarray(n, dtype=float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def _grow(x: np.ndarray, limit: int, random: np.random.Generator) -> tuple[list, list, list]:
    column, value, right = [], [], []

    def node(rows: np.ndarray, depth: int) -> None:
        at = len(column)
        column.append(-1), value.append(depth + float(average_path(len(rows)))), right.append(-1)
        spread = np.ptp(x[rows], axis=0) if len(rows) else np.zeros(x.shape[1])
        if depth >= limit or len(rows) <= 1 or not (spread > 0).any():
            return
        c = int(random.choice(np.flatnonzero(spread > 0)))
        v = float(random.uniform(x[rows, c].min(), x[rows, c].max()))
        left = x[rows, c] <= v
        column[at], value[at] = c, v
        node(rows[left], depth + 1)
        right[at] = len(column)
        node(rows[~left], depth + 1)

    node(np.arange(len(x)), 0)
    return column, value, right


def drawn_rows(matrix: DataFrame, cols: list[str], trees: int, share: float, seed: int) -> DataFrame:
    """The rows with each tree they enter (column tree): every tree takes a row with chance `share`, by hashes of the row.

    A row is looked at once for its first tree (the gap to it is geometric), and only a row that has one is looked at for
    the trees after it; so of a big table few rows are copied, none for all trees. Equal rows enter the same trees.
    """
    row = ["entity_id", *cols]
    if share >= 1:
        return matrix.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    u = (F.shiftrightunsigned(F.xxhash64(*row, F.lit(seed), F.lit("first")), 11) + 0.5) / float(2**53)
    first = F.floor(F.log(u) / float(np.log1p(-share)))
    entered = matrix.withColumn("_first", F.least(first, F.lit(trees)).cast("int")).where(F.col("_first") < trees)
    least = int(-(2**63) + share * (2**64 - 1))
    later = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: (t > F.col("_first")) & (F.xxhash64(*row, F.lit(seed), t) < least))
    return entered.withColumn("tree", F.explode(F.concat(F.array("_first"), later))).drop("_first")


def fit_forest(matrix: DataFrame, cols: list[str], trees: int = 100, sample: int = 256, seed: int = 42) -> Forest:
    """Each tree gets the `sample` rows of lowest hash of those that enter it, about twice as many as it takes.

    The result depends on the rows and the seed alone, not on the partitioning. The forest is trees*sample nodes at most.
    """
    n = matrix.count()
    scale = scales(matrix, cols)
    size = min(sample, n)
    if n == 0:
        return Forest([], 0, cols, scale)
    share = min(1.0, 2.0 * size / n + 20.0 / n)
    drawn = drawn_rows(matrix, cols, trees, share, seed).withColumn("h", F.xxhash64("entity_id", *cols, "tree", F.lit(seed + 1)))
    first = drawn.withColumn("_r", F.row_number().over(Window.partitionBy("tree").orderBy("h", "entity_id"))).where(F.col("_r") <= size).drop("_r")

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "entity_id"])
        tree = int(pdf["tree"].iloc[0])
        x = np.stack([(pdf[c].to_numpy() - scale[c][0]) / scale[c][1] for c in cols], axis=1)
        c, v, r = _grow(x, int(np.ceil(np.log2(max(2, size)))), np.random.default_rng([seed, tree]))
        return pd.DataFrame({"tree": [tree], "c": [c], "v": [v], "r": [r]})

    grown = first.groupBy("tree").applyInPandas(grow, "tree int, c array<int>, v array<double>, r array<int>")
    rows = sorted(grown.collect(), key=lambda r: r["tree"])
    return Forest([(np.array(r["c"]), np.array(r["v"]), np.array(r["r"])) for r in rows], size, cols, scale)


def score_forest(matrix: DataFrame, forest: Forest, entity: str, contamination: float = 0.1) -> DataFrame:
    """entity_id, entity_type, anomaly_score (decision function; low is odd), is_anomaly_predicted, and the features.

    The offset is the contamination quantile of the scores, so about that share of rows is flagged.
    """
    shipped = matrix.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def raw(features: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        f = shipped.value
        for pdf in features:
            x = np.stack([(pdf[c].to_numpy() - f.scale[c][0]) / f.scale[c][1] for c in f.cols], axis=1) if len(pdf) else np.zeros((0, len(f.cols)))
            depth = np.zeros(len(x))
            for c, v, r in f.trees:
                at = np.zeros(len(x), dtype=int)
                inner = c[at] >= 0
                while inner.any():
                    i = np.flatnonzero(inner)
                    goes_right = x[i, c[at[i]]] > v[at[i]]
                    at[i] = np.where(goes_right, r[at[i]], at[i] + 1)
                    inner = c[at] >= 0
                depth += v[at]
            yield pd.Series(-(2.0 ** (-(depth / max(1, len(f.trees))) / max(float(average_path(f.sample)), 1e-9))))

    scored = stored(matrix.withColumn("_s", raw(F.struct(*forest.cols))), "scores")  # trees are walked once a row
    out = scored.withColumn("anomaly_score", F.col("_s") - F.lit(quantile(scored, "_s", contamination)))
    named = [F.col(c).alias(f"feature_{i + 1}") for i, c in enumerate(forest.cols)]
    return out.select("entity_id", F.lit(entity).alias("entity_type"), F.when(F.col("anomaly_score") < 0, 1).otherwise(0).alias("is_anomaly_predicted"), r6("anomaly_score").alias("anomaly_score"), *named)


def save_forest(spark: SparkSession, forest: Forest, path: str) -> None:
    """The forest as a table: a row per tree, with what scoring needs besides."""
    means, deviations = ([float(forest.scale[c][k]) for c in forest.cols] for k in (0, 1))
    rows = [(i, c.tolist(), v.tolist(), r.tolist()) for i, (c, v, r) in enumerate(forest.trees)] or [(-1, [], [], [])]
    schema = "tree int, split_column array<int>, split_value array<double>, right_child array<int>, sample int, cols array<string>, means array<double>, deviations array<double>"
    spark.createDataFrame([(*r, int(forest.sample), forest.cols, means, deviations) for r in rows], schema).coalesce(1).write.mode("overwrite").parquet(path)


def load_forest(spark: SparkSession, path: str) -> Forest:
    """The forest that save_forest wrote; it scores as the one saved did, to the bit."""
    rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r["tree"])  # trees*sample nodes at most
    one = rows[0]
    trees = [(np.array(r["split_column"]), np.array(r["split_value"]), np.array(r["right_child"])) for r in rows if r["tree"] >= 0]
    return Forest(trees, one["sample"], list(one["cols"]), {c: (m, s) for c, m, s in zip(one["cols"], one["means"], one["deviations"])})


def append_predictions(pred: DataFrame, path: str, created_at: str) -> DataFrame:
    """Add a scoring run to the predictions table, stamped with created_at; runs before it stay. Returns the whole table.

    A run is a folder of its time, written whole, so a run that is repeated under one time and entity type replaces itself.
    """
    stamped = pred.withColumn("created_at", F.lit(created_at).cast("timestamp"))
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("created_at", "entity_type").parquet(path)
    table = pred.sparkSession.read.schema(stamped.schema).parquet(path)
    return table.select(*stamped.columns)


def model_metrics(pred: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """entity_type, n, anomalies, precision, recall and f1 per entity type of pred.

    labels (entity_id, entity_type, is_anomaly; the first of repeated ones by flag, 1 first) are the truth for their types,
    entities without a label being normal; types without any label have no truth, and 0 in all three measures.
    """
    counts = [F.count(F.lit(1)).alias("n"), F.sum("is_anomaly_predicted").alias("anomalies")]
    if labels is None:
        return pred.groupBy("entity_type").agg(*counts, *[F.lit(0.0).alias(c) for c in ("precision", "recall", "f1")])
    truth = labels.groupBy("entity_type", "entity_id").agg(F.max("is_anomaly").alias("_y"))
    hit = (F.col("is_anomaly_predicted") == 1) & (F.col("_y") == 1)
    by = pred.join(truth, ["entity_type", "entity_id"], "left").groupBy("entity_type").agg(*counts, F.count_if(hit).alias("_tp"), F.coalesce(F.sum("_y"), F.lit(0)).alias("_pos"))
    p, r = safe_div(F.col("_tp"), F.col("anomalies")), safe_div(F.col("_tp"), F.col("_pos"))
    measured = by.withColumn("precision", p).withColumn("recall", r).withColumn("f1", safe_div(2 * p * r, p + r))
    return measured.select("entity_type", "n", "anomalies", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


def anomaly_rates(pred: DataFrame) -> DataFrame:
    return pred.groupBy("entity_type").agg(F.count("*").alias("total"), F.sum("is_anomaly_predicted").alias("anomalies"), r6(100.0 * F.avg("is_anomaly_predicted")).alias("pct"))
