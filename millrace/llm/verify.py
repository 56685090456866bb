"""Exact five-word Jaccard over groups of candidates, whatever their size."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import give_back, written
from millrace.llm.sieve import Sieve

SIMILAR = 0.8
PERCENT = 80  # SIMILAR, in whole per cent
BLOCK = 1 << 16  # shingles of a block: some 6 MB as sets
SENT_OUT = 1_000_000  # rows of 8 to 60 bytes that may be broadcast; beyond, joins shuffle what a filter of them lets through


def maybe_sent(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast of df if its counted rows are few enough; else Spark chooses, and splits hot keys."""
    return F.broadcast(df) if rows <= SENT_OUT else df


def matched(df: DataFrame, small: DataFrame, rows: int, on: list[str], key: Column | None = None, how: str = "inner") -> DataFrame:
    """df joined with small, whose rows were counted: small is sent out if they are few; else a filter of its keys goes
    out, and only the rows of df that it lets through are shuffled. key: a hash of the columns `on`, unless that is one."""
    if rows <= SENT_OUT:
        return df.join(F.broadcast(small), on, how)
    key = F.col(on[0]) if key is None else key
    return df.where(Sieve(small, key, rows).holds(key)).join(small, on, how)


def alike(one: frozenset, other: frozenset, percent: int) -> bool:
    if 100 * min(len(one), len(other)) < percent * max(len(one), len(other)):
        return False
    both = len(one & other)
    return 100 * both >= percent * (len(one) + len(other) - both)


def _parts(members: list[tuple[int, frozenset]], percent: int) -> list[list[tuple[int, frozenset]]]:
    """The components of sets of a Jaccard of `percent` or more, each with its least member first."""
    left, parts = sorted(members, key=lambda m: m[0]), []
    while left:
        part, front, rest = left[:1], left[:1], left[1:]
        while front and rest:
            one, apart = front.pop()[1], []
            for m in rest:
                if alike(one, m[1], percent):
                    front.append(m)
                    part.append(m)
                else:
                    apart.append(m)
            rest = apart
        parts.append(part)
        left = rest
    return parts


def _linked(sides: tuple[dict, dict], percent: int) -> Iterator[tuple[int, int]]:
    """One link per member to the first of its component; with two sides, one per pair of their components that meet.

    (The links within a side are those of a group of its own.)
    """
    left, right = (_parts(list(s.items()), percent) for s in sides)
    if not right:
        for part in left:
            yield from ((part[0][0], m[0]) for m in part[1:])
        return
    for one in left:
        for other in right:
            if any(alike(a, b, percent) for _, a in one for _, b in other):
                yield one[0][0], other[0][0]


def _verify(batches: Iterator[pd.DataFrame], percent: int = PERCENT) -> Iterator[pd.DataFrame]:
    """Links within each group, over rows (key, sig, side, shingles) sorted by key; one group is held at a time."""
    group, sides = None, ({}, {})
    for batch in batches:
        found: list[tuple[int, int]] = []
        for g, sig, side, shingles in zip(batch["key"].tolist(), batch["sig"].tolist(), batch["side"].tolist(), batch["shingles"]):
            if g != group:
                found += _linked(sides, percent)
                group, sides = g, ({}, {})
            if sig not in sides[side]:
                sides[side][sig] = frozenset(shingles.tolist())
        yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")
    yield pd.DataFrame(list(_linked(sides, percent)), columns=["a", "b"], dtype="int64")
    give_back()


def compared(groups: DataFrame, bodies: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links within each key of groups (key, sig, side); a task holds the sets of one key."""
    dealt = groups.join(bodies, "sig").select("key", "sig", "side", "shingles").repartition("key").sortWithinPartitions("key")
    return dealt.mapInPandas(partial(_verify, percent=percent), "a long, b long")


def off_hub(tested: DataFrame, bodies: DataFrame, *, block: int = BLOCK, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) of the sets that are not near, over rows (key, sig, near, size of the set).

    The near ones of a key are one component already. The others have blocks of their own: they meet one another, and
    the blocks of the near ones, each pair of blocks on its own.
    """
    held = lambda cond, name: F.greatest(F.lit(0), F.ceil(F.sum(F.when(cond, F.col("size"))) / block)).cast("int").alias(name)
    sizes = tested.groupBy("key").agg(held(~F.col("near"), "off_blocks"), held(F.col("near"), "near_blocks")).where("off_blocks > 0")
    dealt = tested.join(sizes, "key").withColumn("near_blocks", F.coalesce("near_blocks", F.lit(0)))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias("other")
    off = dealt.where(~F.col("near")).withColumn("own", F.pmod(F.xxhash64("sig"), F.col("off_blocks")).cast("int"))
    near = dealt.where("near").withColumn("own", F.pmod(F.xxhash64("sig"), F.col("near_blocks")).cast("int"))
    among = off.select("key", "sig", "own", numbers("off_blocks")).select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "sig", (F.col("own") > F.col("other")).cast("int").alias("side"))
    mixed = off.where("near_blocks > 0").select("key", "sig", "own", numbers("near_blocks")).select(F.xxhash64("key", "own", "other", F.lit("near")).alias("key"), "sig", F.lit(0).alias("side"))
    others = near.select("key", "sig", "own", numbers("off_blocks")).select(F.xxhash64("key", "other", "own", F.lit("near")).alias("key"), "sig", F.lit(1).alias("side"))
    return compared(among.unionAll(mixed).unionAll(others).distinct(), bodies, percent)


def verified_links(members: DataFrame, bodies: DataFrame, *, together: int, block: int = BLOCK, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of a Jaccard of `percent` or more that share a key.

    members: (key, n, sig, c), n rows per key, c the weight of a set; bodies: (sig, shingles). Up to `together` sets of a
    key are compared in one go. In a larger group each is compared with the hub, the weightiest; what the hub links is one
    component already, and what it does not link meets all others in blocks of about `block` shingles, each pair of
    blocks on its own: a task holds two blocks, whether the sets are many or long.
    """
    alone = members.where(F.col("n") <= together).select("key", "sig", F.lit(0).alias("side"))
    large = members.where(F.col("n") > together)
    if not large.limit(1).count():
        return compared(alone, bodies, percent).distinct()
    counts = large.groupBy("key").agg(F.max_by("sig", F.struct("c", "sig")).alias("hub"))
    dealt = written(large.join(counts, "key").select("key", "n", "hub", "sig"), "large")
    links = compared(alone, bodies, percent)
    large = dealt.where(F.col("sig") != F.col("hub"))
    both = F.size(F.array_intersect("shingles", "theirs"))
    hubs = bodies.select(F.col("sig").alias("hub"), F.col("shingles").alias("theirs"))
    tested = large.join(bodies, "sig").join(hubs, "hub").withColumn("near", 100 * both >= percent * (F.size("shingles") + F.size("theirs") - both))
    tested = written(tested.select("key", "hub", "sig", "near", F.size("shingles").alias("size")), "tested")
    links = links.unionAll(tested.where("near").select(F.col("hub").alias("a"), F.col("sig").alias("b")))
    if tested.where(~F.col("near")).limit(1).count():
        links = links.unionAll(off_hub(tested, bodies, block=block, percent=percent))
    return links.distinct()
