"""Exact top-k by inner product with Fagin's threshold algorithm over sorted per-dimension lists.

Rows are dealt to blocks; each block keeps a list per dimension, sorted by component. A query reads the lists from
their upper end where its own component is positive and from the lower end where it is negative, and scores the rows
that it meets; it may stop at the depth where no unmet row can reach its kth best score: the threshold is the product
with the components at that depth. First every part of the queries searches one block, which gives each query a kth
best score; with it, the ends of a block's lists alone (depth 0) rule out whole blocks, which are then not sent to the
part at all, and elsewhere they tell the depth to stop at. Where that depth shows as good as all rows, the query takes
the lists to their end, as one product with the block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import bucket_of, small_batches, written

BLOCK_ROWS = 32768  # 4 MB at two bytes a component
QUERY_ROWS = 1024
FIRST_DEPTH = 8  # read before a query has k scores
SCALE = 256.0
LARGEST = float(2**63 - 1024)  # the greatest double that is a long


def vectors(rows: DataFrame, *, key: str, vector: str, scale: float = SCALE) -> DataFrame:
    """(id, v): floor(scale * x) of every component as double; one row per id.

    Null ids, null or empty vectors, and vectors with a null, infinite or NaN component take no part. Of several
    vectors of an id the least one (component by component) stays; repeated rows count once.
    """
    x = F.col(vector).cast("array<double>")
    fine = F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(F.lit(scale) * c).cast("double"))
    return rows.where(fine).select(F.col(key).cast("long").alias("id"), whole.alias("v")).groupBy("id").agg(F.min("v").alias("v"))


def _packed(rows: DataFrame, block_rows: int, name: str) -> DataFrame:
    """(dims, name, ids, matrix, top, low): rows of equal dimension in blocks of about block_rows, in the least type that
    holds all their components, with the ends of their lists."""
    n = max(1, -(-rows.count() // block_rows))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        m = np.stack(pdf["v"].to_list())
        kind = next((t for t in ("<i2", "<i4") if np.abs(m).max() <= np.iinfo(t).max), "<f8")
        return pd.DataFrame({name: [int(pdf["_b"].iloc[0])], "dims": [int(pdf["dims"].iloc[0])], "ids": [pdf["id"].to_numpy(np.int64).tobytes()], "kind": [kind], "matrix": [m.astype(kind).tobytes()], "top": [m.max(axis=0)], "low": [m.min(axis=0)]})

    dealt = rows.withColumn("dims", F.size("v")).withColumn("_b", bucket_of(F.col("id"), n))
    packed = dealt.repartition(F.col("dims"), F.col("_b")).groupBy("dims", "_b").applyInPandas(pack, f"{name} int, dims int, ids binary, kind string, matrix binary, top array<double>, low array<double>")
    return written(packed, name)


def _matrix(data: bytes, kind: str, dims: int, exact: bool) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(-1, dims).astype(np.float64 if exact else np.longdouble)


class Lists:
    """The rows of a block and its sorted lists."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        self.ids, self.matrix = ids, matrix
        self.order = np.argsort(matrix, axis=0, kind="stable")  # ascending per dimension
        self.sorted = np.take_along_axis(matrix, self.order, axis=0)

    def bound(self, up: np.ndarray, down: np.ndarray, depth: int) -> np.ndarray:
        """The highest score that a row beyond depth can have, per query (positive and negative parts)."""
        if depth >= len(self.ids):
            return np.full(len(up), -np.inf)
        return up @ self.sorted[len(self.ids) - 1 - depth] + down @ self.sorted[depth]

    def met(self, query: np.ndarray, depth: int) -> np.ndarray:
        """Rows that the query's lists show down to a depth."""
        n = len(self.ids)
        return np.unique(np.concatenate([self.order[n - min(depth, n) :, query > 0].ravel(), self.order[: min(depth, n), query < 0].ravel()]))


def threshold_search(block: Lists, query_ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray) -> tuple[list[tuple[int, int, float]], np.ndarray, int]:
    """(query, id, score) of each query's best k rows of the block, where they reach floor, the query's kth best so far.

    Returns them with the raised floors and the number of rows scored. Ties are kept: a query goes on while an unmet
    row can equal its kth score, since its id may be smaller.
    """
    n, scored, floor = len(block.ids), 0, floor.copy()
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    best: list[list[tuple[float, int]]] = [[] for _ in query_ids]  # (-score, id)

    def take(i: int, rows: np.ndarray, scores: np.ndarray) -> None:
        fine = (block.ids[rows] != query_ids[i]) & (scores >= floor[i])
        rows, scores = rows[fine], scores[fine]
        if len(rows) > k:
            top = scores >= np.partition(scores, -k)[-k]
            rows, scores = rows[top], scores[top]
        best[i] = sorted(zip((-scores).tolist(), block.ids[rows].tolist()))[:k]
        if len(best[i]) == k:
            floor[i] = max(floor[i], -best[i][-1][0])

    def read(i: int, depth: int) -> None:
        nonlocal scored
        rows = block.met(queries[i], depth)
        scored += len(rows)
        take(i, rows, np.clip(block.matrix[rows] @ queries[i], -LARGEST, LARGEST))

    active = np.flatnonzero(block.bound(up, down, 0) >= floor)
    for i in active:
        if np.isneginf(floor[i]) and FIRST_DEPTH < n:
            read(i, FIRST_DEPTH)
    stop, depth, left = np.full(len(query_ids), n), 1, active
    while len(left) and depth < n:
        done = block.bound(up[left], down[left], depth) < floor[left]
        stop[left[done]] = depth
        left, depth = left[~done], 2 * depth
    lists = (queries != 0).sum(axis=1) * stop < n  # fewer rows than the block has
    for i in active[lists[active]]:
        read(i, int(stop[i]))
    rest = active[~lists[active]]
    every = np.arange(n)
    for part in np.array_split(rest, -(-len(rest) // 256)) if len(rest) else []:
        scores = np.clip(queries[part] @ block.matrix.T, -LARGEST, LARGEST)  # the lists' end
        scored += scores.size
        for i, row in zip(part, scores):
            take(i, every, row)
    return [(int(query_ids[i]), r, -s) for i, found in enumerate(best) for s, r in found], floor, scored


FOUND = "query_id long, vec_id long, score long"


def top_k(rows: DataFrame, *, k: int = 5, key: str = "vec_id", vector: str = "embedding", every: int = 50, scale: float = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by `every`, the k best other rows of its dimension.

    Ties go to the smaller id; fewer than k others give fewer rows. Products are exact: components are whole numbers
    and sums of doubles below 2**53, or else of extended doubles below 2**63; greater scores become the ends of a long's
    range. Parts of QUERY_ROWS queries meet blocks of BLOCK_ROWS rows by a key, so no task holds more than one pair.
    Parts go to blocks, not blocks to parts: a part is a hundredth of a block or less.
    """
    small_batches(rows.sparkSession)
    whole = written(vectors(rows, key=key, vector=vector, scale=scale), "vectors")
    largest = whole.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))).first()[0]
    exact = largest is None or largest < 2.0**53
    blocks = _packed(whole, BLOCK_ROWS, "block")
    asked = _packed(whole.where(F.col("id") % every == 0), QUERY_ROWS, "part").select("dims", "part", F.col("ids").alias("query_ids"), F.col("kind").alias("query_kind"), F.col("matrix").alias("query_matrix"))
    ends = blocks.groupBy("dims").agg(F.min("block").alias("low_block"), F.max("block").alias("high_block"), F.count(F.lit(1)).alias("n_blocks"))
    names = ["dims", "block", "ids", "kind", "matrix", "part", "query_ids", "query_kind", "query_matrix", "floors"]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, lists = None, None
        for batch in batches:
            for dims, at, ids, kind, matrix, part, q_ids, q_kind, q_matrix, floors in batch[names].itertuples(index=False):
                if (dims, at) != last:
                    last, lists = (dims, at), Lists(np.frombuffer(ids, np.int64), _matrix(matrix, kind, dims, exact))
                own = np.frombuffer(q_ids, np.int64)
                floor = np.full(len(own), -np.inf) if floors is None else np.array(floors, np.float64)
                found, floor, _ = threshold_search(lists, own, _matrix(q_matrix, q_kind, dims, exact), k, floor)
                yield pd.DataFrame({"dims": [dims], "part": [part], "first": [at], "floors": [floor.astype(np.float64)], "found": [[{"query_id": q, "vec_id": r, "score": int(x)} for q, r, x in found]]})

    def met(pairs: DataFrame) -> DataFrame:
        return pairs.repartition("dims", "block").sortWithinPartitions("dims", "block").mapInPandas(search, f"dims int, part int, first int, floors array<double>, found array<struct<{FOUND.replace(' ', ':').replace(',:', ',')}>>")

    # Every part searches the block of its number first (the numbers of a dimension's blocks may have gaps).
    order = Window.partitionBy("dims").orderBy("block")
    numbered = blocks.withColumn("turn", F.row_number().over(order) - 1)
    start = asked.join(ends, "dims").withColumn("turn", F.pmod("part", "n_blocks")).withColumn("floors", F.lit(None).cast("array<double>"))
    first = written(met(start.drop("low_block", "high_block", "n_blocks").join(numbered, ["dims", "turn"])), "first")
    found = first.select(F.inline("found"))
    if blocks.groupBy("dims").count().where("count > 1").limit(1).count():
        known = asked.join(first.select("dims", "part", "first", "floors"), ["dims", "part"])
        pairs = known.join(blocks.select("dims", "block", "top", "low"), "dims").where(F.col("block") != F.col("first"))

        @F.pandas_udf("array<int>")
        def hopeful(dims: pd.Series, kind: pd.Series, matrix: pd.Series, floors: pd.Series, top: pd.Series, low: pd.Series) -> pd.Series:
            out = []
            for d, t, m, f, hi, lo in zip(dims, kind, matrix, floors, top, low):
                q = _matrix(m, t, d, exact)
                out.append(np.flatnonzero(np.maximum(q, 0) @ hi + np.minimum(q, 0) @ lo >= np.array(f)).astype(np.int32))
            return pd.Series(out, dtype=object)

        kept = pairs.withColumn("some", hopeful("dims", "query_kind", "query_matrix", "floors", "top", "low")).where(F.size("some") > 0).drop("top", "low", "first", "some")
        found = found.unionAll(met(kept.join(blocks, ["dims", "block"])).select(F.inline("found")))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
