"""Lineage of tables from its records: everything up and down the line, and the history of each table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import bucketed, parts_for, stored


FEW = 1_000_000  # rows that are sent to every executor


def closure(edges: DataFrame) -> DataFrame:
    """(src, dst, depth) for every pair of different nodes with a path from src to dst, depth the length of the shortest.

    Downstream of a node are the rows with it as src, upstream those with it as dst. Cycles, hubs, repeated edges and
    nulls (which link nothing) are allowed. A round doubles the length that is known: a shortest path of more than d and
    up to 2d edges is one of exactly d, which are the pairs found last, and one of up to d. So only the frontier is
    joined, the number of rounds is the logarithm of the longest path, and none runs without a pair of exactly d.

    Each round's pairs are a table in the shared folder, bucketed by src, so that what is known is never shuffled again:
    it is joined to the frontier and compared with new pairs where it lies. A frontier that ends in few nodes, whose
    paths are few, is not shuffled either. A node's pairs downstream lie in one bucket.
    """
    parts, tables, length = parts_for(edges, 100_000), [], 1
    new = edges.where("src <> dst").select("src", "dst").repartition(parts, "src").distinct().withColumn("depth", F.lit(1))
    while True:
        tables.append(bucketed(new, "src", parts, "paths"))
        found = [t for t, _ in tables]
        front = found[-1].where(F.col("depth") == length).select("src", F.col("dst").alias("_mid"), F.col("depth").alias("_d"))
        mids = front.agg(F.approx_count_distinct("_mid")).first()[0]
        if not mids:
            break
        longer = _through(front, found, mids, parts).where("src <> dst").select("src", "dst", (F.col("_d") + F.col("_e")).alias("depth"))
        both = reduce(DataFrame.unionByName, [*found, longer])  # what is known comes first: Spark then sees that the union is partitioned by src
        new = both.groupBy("src", "dst").agg(F.min("depth").alias("depth")).where(F.col("depth") > length)
        length *= 2
    return edges.sparkSession.read.schema(found[0].schema).parquet(*[path for _, path in tables])


def _through(front: DataFrame, found: list[DataFrame], mids: int, parts: int) -> DataFrame:
    """The frontier joined with the paths from its ends, partitioned by src."""
    rest = [t.select(F.col("src").alias("_mid"), "dst", F.col("depth").alias("_e")) for t in found]
    if mids <= FEW:
        ends = stored(front.select("_mid").distinct(), "ends")
        few = stored(reduce(DataFrame.unionByName, [r.join(F.broadcast(ends), "_mid", "left_semi") for r in rest]), "rest")
        if few.count() <= FEW:
            return front.join(F.broadcast(few), "_mid")
    dealt = front.repartition(parts, "_mid")
    return reduce(DataFrame.unionByName, [dealt.join(r, "_mid") for r in rest]).repartition(parts, "src")


def line_summary(paths: DataFrame) -> DataFrame:
    """Per node the number of nodes upstream and downstream and the longest of the shortest paths either way, from closure()."""
    side = lambda end, n, far: paths.groupBy(F.col(end).alias("node")).agg(F.count("*").alias(n), F.max("depth").alias(far))
    both = side("dst", "upstream", "farthest_up").join(side("src", "downstream", "farthest_down"), "node", "full")
    return both.select("node", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("upstream", "downstream", "farthest_up", "farthest_down")])


def table_history(records: DataFrame) -> DataFrame:
    """The records that name a table as source, target or both, a row for each of its tables: node and role are added."""
    role = F.when(F.col("source").eqNullSafe(F.col("target")), F.array(F.struct(F.col("source").alias("node"), F.lit("both").alias("role")))).otherwise(
        F.array(F.struct(F.col("source").alias("node"), F.lit("source").alias("role")), F.struct(F.col("target").alias("node"), F.lit("target").alias("role")))
    )
    return records.select("*", F.inline(role)).where("node is not null")
