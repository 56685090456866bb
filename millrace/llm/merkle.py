"""Merkle manifest of a dataset: a hash tree per source, a tree over the sources, and a proof for every row.

Leaves are cut into superblocks of FAN**LEVELS rows. A first pass reduces each superblock to its top node; the few nodes
above (one per superblock and upwards) are reduced level by level with DataFrame operations. Then every superblock is
cogrouped with the outer nodes that its proofs need: one call finishes the local reduction, joins local and outer
siblings to proofs and folds each row's leaf up to the root. A source of any size is spread over its superblocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import dropped, or_null, solid, written
from millrace.llm.verify import maybe_sent

FAN = 16
LEVELS = 3  # reduced within a superblock: 4096 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*values: Column) -> Column:
    """SHA-256 (32 bytes) of the values in a row: each as `-` if null, else its UTF-8 byte count, `:` and itself."""
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in (c.cast("string") for c in values)]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def joined_digest(nodes: Column) -> Column:
    """The parent of an array of nodes: SHA-256 of their lowercase hex texts, one after the other."""
    return F.unhex(F.sha2(F.concat_ws("", F.transform(nodes, lambda x: F.lower(F.hex(x)))).cast("binary"), 256))


# --- places ---------------------------------------------------------------------------------------------------------


def placed(rows: DataFrame, group: str, order: Sequence[Column], name: str) -> DataFrame:
    """rows with pos (from 0, within its group), total (rows of the group) and tree (a number per group, ascending with it).

    Rows are range partitioned by group and order and written once; a place is the row's number within its partition
    and group plus the rows of the group in the partitions before. Nothing is numbered in one task.
    """
    keys = [F.col(group).asc_nulls_first(), *order]
    ranged = written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), name)
    ranged = ranged.withColumn("_part", F.shiftright("_at", 33))
    own = Window.partitionBy("_group")
    runs = ranged.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_of")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(own.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = written(runs.select("_group", "_of", "_first", before.alias("_before"), F.sum("_n").over(own).alias("total"), F.min("_first").over(own).alias("tree")), f"{name}-runs")
    found = ranged.join(maybe_sent(runs, runs.count()), ranged[group].eqNullSafe(runs["_group"]) & (ranged["_part"] == runs["_of"]))
    return found.withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_group", "_of", "_first", "_before", "_n")


# --- nodes above the superblocks ------------------------------------------------------------------------------------


def _levels(nodes: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """The runs (tree, run, members) of every level above nodes (tree, pos, node, total), and (tree, node) of the tops.

    most: the largest total. Each level is written; it is a sixteenth of the one below.
    """
    levels, tops = [], nodes.where("total = 1").select("tree", "node")
    while most > 1:
        members = F.transform(F.array_sort(F.collect_list(F.struct("pos", "node"))), lambda x: x["node"])
        runs = written(nodes.where("total > 1").groupBy("tree", F.expr(f"pos div {FAN}").alias("run")).agg(members.alias("members"), F.first("total").alias("total")), "runs")
        levels.append(runs.select("tree", "run", "members"))
        nodes = runs.select("tree", F.col("run").alias("pos"), joined_digest(F.col("members")).alias("node"), F.ceil(F.col("total") / FAN).alias("total"))
        tops = tops.unionAll(nodes.where("total = 1").select("tree", "node"))
        most = -(-most // FAN)
    return levels, tops


def _outer(members: DataFrame, levels: list[DataFrame], first: int) -> DataFrame:
    """(tree, block, level, own, members) of the runs above each (tree, block): own is the place of the block's node."""
    found = []
    for k, runs in enumerate(levels):
        own = members.select("tree", "block", F.expr(f"block div {FAN**k} % {FAN}").cast("int").alias("own"), F.expr(f"block div {FAN ** (k + 1)}").alias("run"))
        found.append(own.join(maybe_sent(runs, runs.count()), ["tree", "run"]).select("tree", "block", F.lit(first + k).alias("level"), "own", "members"))
    out = found[0]
    for f in found[1:]:
        out = out.unionAll(f)
    return out


# --- within a superblock --------------------------------------------------------------------------------------------


def _parent(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _grown(leaves: list[str], total: int, levels: int) -> list[list[str]]:
    """The nodes of each level of a superblock, leaves first; it ends early where its source is one node."""
    grown = [leaves]
    while total > 1 and len(grown) <= levels:
        below = grown[-1]
        grown.append([_parent("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
        total = -(-total // FAN)
    return grown


def _tops(levels: int):
    def top(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        grown = _grown([bytes(x).hex() for x in rows["leaf"]], int(rows["total"].iloc[0]), levels)
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "node": [bytes.fromhex(grown[-1][0])], "total": [-(-int(rows["total"].iloc[0]) // FAN**levels)]})

    return top


SCHEMA = "id long, pos long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _proofs(levels: int, with_proofs: bool):
    def prove(key: tuple, rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        """Proofs and folds of a superblock; outer has its runs above by level, and [subroot, root] at level -1."""
        rows, outer = rows.sort_values("pos"), outer.sort_values("level")
        leaves = [bytes(x).hex() for x in rows["leaf"]]
        shown = [leaf if x is None else bytes(x).hex() for leaf, x in zip(leaves, rows["shown"])]
        grown = _grown(leaves, int(rows["total"].iloc[0]), levels)
        around = []  # (left, right) texts of the siblings of each node, by level; above the block there is one node a level
        for nodes in grown[:-1]:
            around.append([("".join(nodes[i - i % FAN : i]), "".join(nodes[i + 1 : i - i % FAN + FAN])) for i in range(len(nodes))])
        ends = None
        for level, own, members in zip(outer["level"], outer["own"], outer["members"]):
            members = [bytes(x).hex() for x in members]
            if level < 0:
                ends = members
            else:
                around.append([("".join(members[:own]), "".join(members[own + 1 :]))])
        place = lambda i, k: min(i // FAN**k, len(around[k]) - 1)
        above = [""]  # the siblings above each node, level by level downwards
        for k in range(len(around) - 1, 0, -1):
            above = [left + right + above[min(i // FAN, len(above) - 1)] for i, (left, right) in enumerate(around[k])]
        proofs, folded = [], []
        for i, node in enumerate(shown):
            for k in range(len(around)):
                left, right = around[k][place(i, k)]
                node = _parent(left + node + right)
            folded.append(node)
            proofs.append("".join(around[0][i]) + above[min(i // FAN, len(above) - 1)] if around else "")
        out = pd.DataFrame({"id": rows["id"].to_numpy(), "pos": rows["pos"].to_numpy(), "leaf": leaves, "subroot": ends[0], "root": ends[1], "proof_sha256": [_parent(p) for p in proofs], "folded_root": folded})
        out["verified"] = out["folded_root"] == out["root"]
        return out.assign(proof=proofs) if with_proofs else out

    return prove


# --- the operator ---------------------------------------------------------------------------------------------------


def leaves(docs: DataFrame, *, tampered: Column | None = None) -> DataFrame:
    """(id, source, leaf, shown) per row of docs: shown is the leaf of the row with text as in `tampered`, null if that is null."""
    named = docs.select(*[F.col(c) for c in FIELDS], *([tampered.alias("_tampered")] if tampered is not None else []))
    cols = [F.col(c) for c in FIELDS[:-1]]
    shown = F.when(F.col("_tampered").isNotNull(), digest(*cols, F.col("_tampered"))) if tampered is not None else F.lit(None).cast("binary")
    return named.select(solid("doc_id").alias("id"), "source", digest(*cols, F.col("text")).alias("leaf"), shown.alias("shown"))


def manifest(rows: DataFrame, *, levels: int = LEVELS, with_proofs: bool = False) -> DataFrame:
    """Per row of leaves() its leaf, subroot, root, proof digest and the root folded from `shown` (else the leaf).

    Within a source rows ascend by id, null first, then by leaf; sources ascend bytewise, null first. Equal rows have
    equal leaves, so their order does not matter. A lone leaf is its subroot and, if alone, the root, with an empty
    proof. No rows: no result. with_proofs adds the siblings' hex text.
    """
    schema = SCHEMA + (", proof string" if with_proofs else "")
    spark, block = rows.sparkSession, F.expr(f"pos div {FAN**levels}")
    hashed = written(rows.withColumn("_tie", F.monotonically_increasing_id()), "leaves")  # texts are read once
    spots = placed(hashed, "source", [F.col("id"), F.col("leaf"), F.col("_tie")], "ranged").withColumn("block", block)
    dropped(hashed)
    tops = spots.select("tree", "block", "pos", "leaf", "total").groupBy("tree", "block").applyInPandas(_tops(levels), "tree long, pos long, node binary, total long")
    tops = written(tops, "tops")
    most = tops.agg(F.max("total")).first()[0]
    if most is None:
        return spark.createDataFrame([], schema).withColumn("id", or_null("id"))
    upper, subroots = _levels(tops, most)
    ranked = placed(written(subroots, "subroots").withColumn("all", F.lit(0)).withColumnRenamed("tree", "of"), "all", [F.col("of")], "sources")
    ranked = written(ranked, "ranked")
    sources = ranked.count()
    over, root = _levels(ranked.select("tree", "pos", "node", "total"), sources)
    root = bytes(root.first()["node"])
    blocks = tops.select("tree", F.col("pos").alias("block"))
    ends = ranked.select(F.col("of").alias("tree"), F.array("node", F.lit(root)).alias("members"))
    outer = blocks.join(maybe_sent(ends, sources), "tree").select("tree", "block", F.lit(-1).alias("level"), F.lit(0).alias("own"), "members")
    if upper:
        outer = outer.unionAll(_outer(blocks, upper, levels))
    if over:
        above = _outer(ranked.select("tree", F.col("pos").alias("block")), over, 1000)
        above = ranked.select("of", F.col("pos").alias("block")).join(above.drop("tree"), "block").select(F.col("of").alias("tree"), "level", "own", "members")
        outer = outer.unionAll(blocks.join(maybe_sent(above, sources * len(over)), "tree").select("tree", "block", "level", "own", "members"))
    exchanged = spots.select("tree", "block", "id", "pos", "total", "leaf", "shown").groupBy("tree", "block").cogroup(outer.groupBy("tree", "block"))
    return exchanged.applyInPandas(_proofs(levels, with_proofs), schema).withColumn("id", or_null("id"))


def without_capitals(text: Column) -> Column:
    """A-Z in lower case, nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
