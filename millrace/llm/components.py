"""Connected components of a link table, by alternating star operations on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import dropped, written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Link the larger (or the smaller and equal) neighbours of each node to its smallest neighbour, itself included."""
    if large:
        both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))  # combined before the shuffle: hubs are cheap
    joined = both.join(least, "a")
    moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) if large else joined.select("b", "m").unionAll(least.select(F.col("a").alias("b"), "m")).toDF("a", "b")
    return moved.where("a <> b").distinct()


def connected_components(links: DataFrame, *, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of links (a, b): component is the smallest node that can be reached.

    Null ends, self links and repeated links are allowed and add nothing. Each round halves path lengths, roughly; every
    round is written to the shared folder, so the plan stays short and a lost executor costs one round at most.
    """
    edges = written(links.where("a is not null and b is not null and a <> b").select("a", "b").distinct(), "links")
    last = None
    for _ in range(rounds):
        after = written(_star(_star(edges, large=True), large=False), "links")
        dropped(edges)
        edges = after
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == last:
            break
        last = tuple(state)
    else:
        raise RuntimeError(f"no end after {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
