"""Prefix trie over conversations: which turns from the start are shared, by whom, and what sharing saves.

Conversations are range partitioned by their turns, so the members of a node lie side by side. A task takes a block of
rows at a time as a padded matrix of turn ids: numpy's lexsort puts the rows in trie order, column change masks
accumulated by OR mark where nodes start, and reduceat sums up every depth from the deepest. Nodes with a block's first
or last row may go on in another block: their parts are recombined by a hash of their path, and what lies below them
is added up by pointer doubling, so no task holds more than a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import NO_ID, dropped, give_back, or_null, written
from millrace.llm.verify import maybe_sent

CELLS = 1 << 20  # of a block's matrix: 12 MB of ids and sizes
DEEP = 64  # turns that order the ranges; nodes below go with their ancestor there
NOTHING = sha256(b"").hexdigest()


# --- conversations --------------------------------------------------------------------------------------------------


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): per conversation its turns by turn number, null first, as structs of hi, lo and size.

    hi and lo are 128 bits of the SHA-256 of role and text (null is empty), size the text's UTF-8 bytes. Turns with one
    number follow their hash; repeated rows are repeated turns; rows without conv_id take no part. A conversation is
    held as 24 bytes a turn, texts are not moved.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    hexed = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    half = lambda at: F.conv(F.substring(F.col("_hex"), at, 16), 16, -10).cast("long")
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", hexed.alias("_hex"), F.octet_length(text).cast("long").alias("size"))
    one = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", half(1).alias("hi"), half(17).alias("lo"), "size")
    return turns.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: F.struct(x["hi"].alias("hi"), x["lo"].alias("lo"), x["size"].alias("size"))).alias("turns"))


def with_shared_heads(lists: DataFrame, *, group: int, most: int, head: Column) -> DataFrame:
    """turn_lists where each conversation c starts with the first `head` turns of conversation c - c % group.

    All of them if that has fewer, none if it is not there; then c's own turns after its first `head`, which is at most
    `most`. (% keeps the sign of c.)
    """
    heads = lists.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most).alias("_head"))
    joined = lists.withColumns({"_base": F.col("conv_id") - F.col("conv_id") % group, "_h": head.cast("int")}).join(heads, "_base", "left")
    rest = F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns") - F.col("_h"), F.lit(0)))
    first = F.when(F.col("_head").isNull() | (F.col("_h") == 0), F.slice("turns", 1, 0)).otherwise(F.slice("_head", 1, F.greatest("_h", F.lit(1))))
    return joined.select("conv_id", F.concat(first, rest).alias("turns"))


# --- within a block -------------------------------------------------------------------------------------------------

NODES = "key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, size long, first_end long, ends string"


class _Paths:
    """Hashes of the prefixes of a block's rows."""

    def __init__(self, matrix: np.ndarray, halves: np.ndarray):
        self.matrix, self.halves, self.known = matrix, halves, {}

    def key(self, row: int, depth: int) -> bytes:
        keys = self.known.setdefault(row, [sha256(b"").digest()])
        if len(keys) <= depth:
            state = sha256()
            cells = [self.halves[i - 1].tobytes() for i in self.matrix[row, :depth]]
            for c in cells[: len(keys) - 1]:
                state.update(c)
            for c in cells[len(keys) - 1 :]:
                state.update(c)
                keys.append(state.copy().digest())
        return keys[depth]


def block_nodes(conv: np.ndarray, lens: np.ndarray, hi: np.ndarray, lo: np.ndarray, size: np.ndarray, deep: int = DEEP) -> pd.DataFrame:
    """The nodes of a block of conversations (hi, lo, size: of all turns, one after the other).

    Nodes that may go on elsewhere have a key; their numbers count only children and subtrees that end in this block,
    `ends` lists the ids that end in them. The others are finished, `ends` is the hash.
    """
    n, longest = len(conv), int(lens.max(initial=0))
    by = np.lexsort((lo, hi))
    fresh = np.ones(len(by), bool)
    fresh[1:] = (hi[by][1:] != hi[by][:-1]) | (lo[by][1:] != lo[by][:-1])
    ids = np.empty(len(by), np.int32)
    ids[by] = np.cumsum(fresh)
    halves = np.stack([hi[by][fresh], lo[by][fresh]], axis=1)
    filled = np.arange(longest) < lens[:, None]
    matrix, sizes = np.zeros((n, longest), np.int32), np.zeros((n, longest), np.int64)
    matrix[filled], sizes[filled] = ids, size
    order = np.lexsort((conv, *matrix.T[::-1]))
    matrix, sizes, conv, lens = matrix[order], sizes[order], conv[order], lens[order]
    starts = np.ones((n, longest), bool)
    starts[1:] = np.logical_or.accumulate(matrix[1:] != matrix[:-1], axis=1)

    paths, out = _Paths(matrix, halves), []
    at = [np.array([0])] + [np.flatnonzero(starts[:, d]) for d in range(longest)]  # where runs of equal prefixes start, by depth
    edge = (n, 0) if longest < deep else (at[deep][1] if len(at[deep]) > 1 else n, at[deep][-1])
    kids = np.zeros((4, n), np.int64)  # at the first row of each node one deeper: all children; of the finished ones number, leaves, saved
    for d in range(longest, -1, -1):
        run = at[d]
        valid = lens[run] >= d
        sums = np.add.reduceat(kids, run, axis=1)[:, valid]
        count = np.diff(np.r_[run, n])[valid]
        ended = np.add.reduceat((lens == d).astype(np.int64), run)[valid]
        least = np.minimum.reduceat(conv, run)[valid]
        own = run[valid]
        shared = (own == 0) | (valid.nonzero()[0] == len(run) - 1) if d <= deep else (own < edge[0]) | (own >= edge[1])
        last = sizes[own, d - 1] if d else np.zeros(1, np.int64)
        leaf = sums[0] == 0
        leaves, saved = np.where(shared, sums[2], sums[2] + leaf), np.where(shared, sums[3], sums[3] + (count - 1) * last)
        source = np.where(shared & (own != 0) & (d <= deep), n - 1, own)  # a row with the node's path: one for all of the last run's
        keys = [paths.key(r, d) if s else None for r, s in zip(source.tolist(), shared.tolist())]
        up_keys, up_conv = [None] * len(own), np.full(len(own), NO_ID)
        if d:
            above = np.searchsorted(at[d - 1], own, side="right") - 1
            of = at[d - 1][above]
            up_shared = (of == 0) | (above == len(at[d - 1]) - 1) if d - 1 <= deep else (of < edge[0]) | (of >= edge[1])
            up_source = np.where(up_shared & (of != 0) & (d - 1 <= deep), n - 1, of)
            up_keys = [paths.key(r, d - 1) if s else None for r, s in zip(up_source.tolist(), up_shared.tolist())]
            up_conv = np.where(up_shared, NO_ID, np.minimum.reduceat(conv, at[d - 1])[above])
        texts = [",".join(map(str, conv[r : r + e].tolist())) if e else "" for r, e in zip(own.tolist(), ended.tolist())]
        ends = [t if s else sha256(t.encode()).hexdigest() if t else NOTHING for t, s in zip(texts, shared.tolist())]
        numbers = np.where(shared, sums[1], sums[0])
        out.append(pd.DataFrame({"key": keys, "parent_key": up_keys, "conv_id": least, "depth": d, "parent_conv_id": up_conv, "n_convs": count, "n_children": numbers, "n_leaves": leaves, "saved_tokens": saved, "size": last, "first_end": conv[own], "ends": ends}))
        kids = np.zeros((4, n), np.int64)
        kids[0, own] = 1
        done = own[~shared]
        kids[1, done], kids[2, done], kids[3, done] = 1, leaves[~shared], saved[~shared]
    return pd.concat(out, ignore_index=True)


def _blocks(lens: np.ndarray, cells: int) -> Iterator[tuple[int, int]]:
    """Runs of rows whose padded matrix has at most `cells` cells; a longer row runs alone."""
    start, widest = 0, 1
    for i, x in enumerate(lens.tolist()):
        if i > start and (i + 1 - start) * max(widest, x) > cells:
            yield start, i
            start, widest = i, 1
        widest = max(widest, x)
    if start < len(lens):
        yield start, len(lens)


# --- the operator ---------------------------------------------------------------------------------------------------


def _joined_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The hash of each node's ids over its rows (key, first_end, ends), sorted by key and id: a piece at a time."""
    key, state = None, None
    for batch in batches:
        keys, hashes = [], []
        for k, text in zip(batch["key"], batch["ends"]):
            if k != key:
                if key is not None:
                    keys.append(key)
                    hashes.append(state.hexdigest())
                key, state = k, sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield pd.DataFrame({"key": keys, "ends_sha256": hashes}, dtype=object)
    if key is not None:
        yield pd.DataFrame({"key": [key], "ends_sha256": [state.hexdigest()]}, dtype=object)


def _sums_below(nodes: DataFrame, rows: int, deepest: int) -> DataFrame:
    """n_leaves and saved_tokens of nodes (key, up, ...) with those of all nodes below added, by doubling the distance."""
    for _ in range(int(deepest).bit_length()):
        below = nodes.where("up is not null").groupBy(F.col("up").alias("key")).agg(F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved"))
        higher = nodes.select(F.col("key").alias("up"), F.col("up").alias("_up"))
        joined = nodes.join(maybe_sent(below, rows), "key", "left").join(maybe_sent(higher, rows), "up", "left")
        plus = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0))).alias(c)
        done = written(joined.select("key", F.col("_up").alias("up"), plus("n_leaves", "_leaves"), plus("saved_tokens", "_saved")), "below")
        dropped(nodes)
        nodes = done
    return nodes


def prefix_trie(lists: DataFrame, *, cells: int = CELLS, deep: int = DEEP) -> DataFrame:
    """Per node of the trie of (conv_id, turns): its smallest member and what is asked of it.

    conv_id, depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Each
    conv_id has one row. Conversations without turns end in the root. No conversations: no nodes. Members that end in
    one node are hashed in the order of their ids, as pieces of a block each: only that text passes one task in a row.
    """
    keyed = lists.select("conv_id", F.transform("turns", lambda x: x["hi"]).alias("hi"), F.transform("turns", lambda x: x["lo"]).alias("lo"), F.transform("turns", lambda x: x["size"]).alias("size"), F.transform(F.slice("turns", 1, deep), lambda x: F.struct(x["hi"].alias("hi"), x["lo"].alias("lo"))).alias("start"))
    keyed = written(keyed, "paths")  # the ranges' bounds are sampled first: the rows are built once

    def nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = lambda x: np.concatenate([np.empty(0, np.int64), *x])
        for batch in batches:
            lens = batch["hi"].str.len().to_numpy(np.int64)
            for a, b in _blocks(lens, cells):
                part = batch.iloc[a:b]
                yield block_nodes(part["conv_id"].to_numpy(), lens[a:b], whole(part["hi"]), whole(part["lo"]), whole(part["size"]), deep)
        give_back()

    ranged = keyed.repartitionByRange("start", "conv_id").sortWithinPartitions("start", "conv_id")
    found = written(ranged.select("conv_id", "hi", "lo", "size").mapInPandas(nodes, NODES), "nodes")
    dropped(keyed)
    parts = found.where("key is not null")
    merged = parts.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent_key", ignorenulls=True).alias("up"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.max("size").alias("size"))
    merged = written(merged, "merged")
    rows, deepest = merged.agg(F.count(F.lit(1)), F.max("depth")).first()
    more = merged.groupBy(F.col("up").alias("key")).agg(F.count(F.lit(1)).alias("more"))
    merged = merged.join(maybe_sent(more, rows), "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    own = F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")
    below = written(merged.select("key", "up", (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("n_leaves"), own.alias("saved_tokens")), "below")
    below = _sums_below(below, rows, deepest or 0)
    pieces = parts.where("ends <> ''").select("key", "first_end", "ends").repartition("key").sortWithinPartitions("key", "first_end")
    ends = pieces.mapInPandas(_joined_ends, "key binary, ends_sha256 string")
    names = merged.select(F.col("key").alias("up"), F.col("conv_id").alias("_parent"))
    shared = merged.drop("n_leaves", "saved_tokens").join(maybe_sent(below.drop("up"), rows), "key").join(maybe_sent(ends, rows), "key", "left").join(maybe_sent(names, rows), "up", "left")
    shared = shared.select("conv_id", "depth", F.col("_parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))
    alone = found.where("key is null").withColumnRenamed("parent_key", "up").join(maybe_sent(names, rows), "up", "left")
    alone = alone.select("conv_id", "depth", F.coalesce(or_null("parent_conv_id"), "_parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256"))
    return alone.unionAll(shared)
