"""Quality classifier: naive Bayes support vectors.

Indicators of hashed character n-grams, and of n-grams of repeated words, are scaled by the log ratio of their rates in good and bad texts; a linear
hinge-loss model over the scaled indicators is fitted by dual coordinate descent; a sigmoid over its margin
gives a score between 0 and 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import give_back, mixed, sampled, small_batches

BITS = 16
ORDERS = (1, 2, 3)
RUN = 8
PIECE = 1 << 20


@dataclass
class QualityModel:
    weights: np.ndarray  # log ratio times linear weight, by feature
    ratio: np.ndarray
    bias: float
    slope: float
    shift: float


def indicators(text: str | None) -> np.ndarray:
    """The sorted features of a text: hashes of its n-grams of case-kept characters, each once."""
    seen = np.zeros(1 << BITS, dtype=bool)
    whole = text or ""
    for k in range(0, len(whole), PIECE):
        part = whole[k : k + PIECE + max(ORDERS) - 1]
        code = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        for n in ORDERS:
            size = len(code) - n + 1
            if size < 1:
                break
            h = np.full(size, n, dtype=np.uint64)
            for i in range(n):
                with np.errstate(over="ignore"):
                    h = h * np.uint64(0x100000001B3) + code[i : i + size]
            seen[(mixed(h) >> np.uint64(64 - BITS)).astype(np.int64)] = True
        words = part.split()
        same = np.array([a == b for a, b in zip(words, words[1:])], dtype=np.uint8)
        if len(same) >= RUN:  # n-grams over "this word repeats the one before"
            runs = np.convolve(same, np.ones(RUN, np.uint8), "valid")
            seen[(mixed(np.unique(runs).astype(np.uint64) + np.uint64(1 << 40)) >> np.uint64(64 - BITS)).astype(np.int64)] = True
    return np.flatnonzero(seen).astype(np.int32)


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, *, cost: np.ndarray, rounds: int = 30, seed: int = 7, tolerance: float = 1e-3) -> np.ndarray:
    """Weights (the last is the bias) of the linear hinge-loss model, one dual variable at a time."""
    w, alpha = np.zeros(size + 1), np.zeros(len(rows))
    diagonal = np.array([v @ v + 1.0 for v in values])
    order, random = np.arange(len(rows)), np.random.default_rng(seed)
    for _ in range(rounds):
        random.shuffle(order)
        worst = 0.0
        for i in order:
            at, v = rows[i], values[i]
            slope = y[i] * (w[at] @ v + w[size]) - 1.0
            aim = min(max(alpha[i] - slope / diagonal[i], 0.0), cost[i])
            if step := aim - alpha[i]:
                worst = max(worst, abs(step))
                w[at] += step * y[i] * v
                w[size] += step * y[i]
                alpha[i] = aim
        if worst < tolerance:
            break
    return w


def train(features: list[np.ndarray], good: np.ndarray, cost: float = 1.0) -> QualityModel:
    """Fit on indicators and 0/1 labels. One class only, or no rows: a constant score of that class's smoothed share."""
    size, good = 1 << BITS, np.asarray(good, dtype=bool)
    n1, n0 = int(good.sum()), int((~good).sum())
    if not n1 or not n0:
        p = (n1 + 1) / (n1 + n0 + 2)
        return QualityModel(np.zeros(size), np.zeros(size), 0.0, 0.0, float(np.log(p / (1 - p))))
    up, down = (np.bincount(np.concatenate([f for f, g in zip(features, good) if g == side] or [np.empty(0, np.int32)]), minlength=size) for side in (True, False))
    ratio = np.log((up + 1) / (n1 + 2)) - np.log((down + 1) / (n0 + 2))
    values = [ratio[f] / max(1e-9, np.linalg.norm(ratio[f])) for f in features]
    y = np.where(good, 1.0, -1.0)
    w = dual_descent(features, values, y, size, cost=np.where(good, cost * (n0 + n1) / (2 * n1), cost * (n0 + n1) / (2 * n0)))
    margin = np.array([w[f] @ v + w[size] for f, v in zip(features, values)])
    slope, shift = 2.0, 0.0
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    for _ in range(50):  # Newton steps of the sigmoid's likelihood
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30)))
        g, q = p - target, np.maximum(p * (1 - p), 1e-9)
        a, b, c = (q * margin**2).sum() + 1e-3, (q * margin).sum(), q.sum() + 1e-3
        ga, gb = (g * margin).sum(), g.sum()
        det = a * c - b * b
        da, db = (c * ga - b * gb) / det, (a * gb - b * ga) / det
        slope, shift = slope - np.clip(da, -2, 2), shift - np.clip(db, -2, 2)
        if abs(da) + abs(db) < 1e-6:
            break
    return QualityModel(w[:size] * ratio, ratio, float(w[size]), float(slope), float(shift))


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", bound: int = 6000) -> QualityModel:
    """Learn from about `bound` labelled rows (chosen by a hash of key, the bound on the sample).

    Labels other than 0 and 1, and null ids, are ignored; an id with several labels counts as bad if one is 0.
    """
    small_batches(docs.sparkSession)
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min(label).cast("int").alias("_good"))
    picked = sampled(known, F.col("_key"), known.count(), bound)
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(F.broadcast(picked), "_key")  # bound rows of 12 bytes

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"_key": batch["_key"], "good": batch["_good"], "at": [indicators(t).tobytes() for t in batch["text"]]})

    got = rows.mapInPandas(features, "_key long, good int, at binary").toArrow()
    order = np.argsort(got.column("_key").to_numpy(), kind="stable")
    at, good = got.column("at").to_pylist(), got.column("good").to_numpy()
    return train([np.frombuffer(at[i], np.int32) for i in order], good[order])


def score_texts(model: QualityModel, texts: list[str | None]) -> np.ndarray:
    out = np.empty(len(texts))
    for i, t in enumerate(texts):
        at = indicators(t)
        norm = np.linalg.norm(model.ratio[at]) if len(at) else 0.0
        out[i] = model.weights[at].sum() / max(norm, 1e-9) + model.bias
    return 1 / (1 + np.exp(-np.clip(model.slope * out + model.shift, -30, 30)))


def score(docs: DataFrame, model: QualityModel, *, text: str = "text", out: str = "score") -> DataFrame:
    """docs with a column `out` from 0 to 1 (replaced if there); null and empty texts get the score of the bias alone."""
    small_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # 2**16 weights

    @F.pandas_udf("double")
    def answer(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series(score_texts(shipped.value, part.tolist()))
        give_back()

    return docs.drop(out).withColumn(out, answer(F.col(text)))
