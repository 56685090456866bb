"""SimHash near-duplicates with covering locality-sensitive hashing.

Fingerprints of 64 bits link at RADIUS or fewer differing bits. Every bit gets a random non-zero vector of RADIUS+1
bits; table v of 2**(RADIUS+1)-1 keeps the bits whose vector has an even product with v. For any RADIUS bits some v is
orthogonal to all their vectors, so any two fingerprints that differ there agree in that table: no link is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import give_back, small_batches, written
from millrace.llm.components import connected_components

WORDS = 3
RADIUS = 2
BITS = 64
HASH_SEED = 42
TOGETHER = 256  # fingerprints of a table's bucket that one task compares directly; larger buckets go by midpoints


# --- fingerprints ---------------------------------------------------------------------------------------------------


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Bit i is set if it is set in over half the XXH64 of the text's shingles, repeats included; no word: 0."""
    import xxhash

    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, HASH_SEED)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = [0, *ends[: len(parts) - words].tolist()]
    stops = (ends[words - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return majority(np.array([digest(joined[a:b], HASH_SEED) for a, b in zip(starts, stops)], dtype="<u8")) % (1 << BITS)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the 64-bit hashes, as a signed number."""
    counts = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[k : k + (1 << 16)], dtype="<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, *, text: str = "text", out: str = "fp", words: int = WORDS) -> DataFrame:
    """docs with the signed 64-bit fingerprint of the whole text in column out."""

    @F.pandas_udf("long")
    def answer(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series(np.array([fingerprint(t, words) for t in part], dtype=np.uint64).view(np.int64))
        give_back()

    small_batches(docs.sparkSession)
    return docs.withColumn(out, answer(F.col(text)))


# --- links ----------------------------------------------------------------------------------------------------------


def covering_masks(radius: int = RADIUS, bits: int = BITS, seed: int = 1) -> list[int]:
    """The bits that each of the 2**(radius+1)-1 tables keeps."""
    vectors = np.random.default_rng(seed).permutation(np.resize(np.arange(1, 1 << (radius + 1)), bits))
    return [sum(1 << i for i, m in enumerate(vectors) if int(m & v).bit_count() % 2 == 0) for v in range(1, 1 << (radius + 1))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def close_links(prints: DataFrame, *, radius: int = RADIUS, together: int = TOGETHER) -> DataFrame:
    """Links (a, b) between distinct values of column fp whose components are those of all pairs at radius or less.

    Buckets of up to `together` fingerprints are compared in one task each and leave one link per member at most.
    In a larger bucket, fingerprints at distance 2 or less share a midpoint: a value at distance 1 or less from both.
    Each member lists its midpoints among the bits that the table left out, and members with a common one are linked to
    the smallest. A midpoint has 65 members at most, so nothing there is quadratic, however large the bucket.
    """
    if radius != 2:
        raise ValueError("midpoints are for radius 2")
    masks = covering_masks(radius)
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k")) for i, m in enumerate(masks)])
    keyed = prints.select("fp", F.explode(tables).alias("x")).select("fp", "x.t", "x.k")
    sizes = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = written(keyed.join(sizes, ["t", "k"]), "buckets")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = [], []
            for found in batch["fps"]:
                left = np.sort(np.array(found, dtype=np.int64))
                while len(left) > 1:  # one component of the bucket after the other
                    reached, front, rest = left[:1], left[:1], left[1:]
                    while len(front) and len(rest):
                        near = (np.bitwise_count((front[:, None] ^ rest[None, :]).view(np.uint64)) <= radius).any(axis=0)
                        front, rest = rest[near], rest[~near]
                        reached = np.concatenate([reached, front])
                    b += reached[1:].tolist()
                    a += [reached[0]] * (len(reached) - 1)
                    left = rest
            yield pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    small = members.where(F.col("n") <= together).groupBy("t", "k").agg(F.collect_list("fp").alias("fps")).select("fps").mapInPandas(compare, "a long, b long")
    free = F.element_at(F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(BITS) if not m >> i & 1]) for m in masks]), F.col("t") + 1)
    middles = members.where(F.col("n") > together).select("fp", F.explode(F.transform(free, lambda bit: F.col("fp").bitwiseXOR(bit))).alias("mid")).distinct()
    hub = middles.groupBy("mid").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    large = middles.join(hub, "mid").select("a", F.col("fp").alias("b"))
    return small.unionAll(large).where("a <> b").distinct()


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, fp, component_id) per row: component_id is the smallest doc_id reachable over close fingerprints.

    Null and blank texts have fingerprint 0 and link like any other; repeated rows are in one component; a row with a
    null id gets a component as any other, and never names one unless all its members have null ids.
    """
    prints = written(with_fingerprints(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), words=words).select("doc_id", "fp"), "prints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    linked = written(connected_components(close_links(distinct)), "components")
    named = distinct.join(linked, distinct["fp"] == linked["node"], "left").select("fp", "first", F.coalesce("component", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = written(named.join(ids, "root").select("fp", "component_id"), "classes")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")
