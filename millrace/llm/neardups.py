"""Near copies of whole documents for the pipeline: covering SimHash links and MinHash bands, verified by exact Jaccard.

The pipeline's stage asks for a Jaccard of 0.8 over five-word shingles. There two SimHashes differ in about 15 % of
their bits whatever their length, so a covering for all such pairs would need hundreds of tables. The stage therefore
takes two sets of candidates: fingerprints over five-word shingles linked by the covering masks of simhash.py (exact and
very close copies, however many), and texts that share one of 16 bands of four MinHashes, which miss 0.02 % of the pairs
at 0.8. Every candidate of either kind is verified by exact Jaccard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import NO_ID, dropped, give_back, mixed, slices, small_batches, solid, written
from millrace.llm.components import connected_components
from millrace.llm.repeats import PIECE, SHINGLE, _flat, _shingles, word_hashes
from millrace.llm.simhash import close_links, majority
from millrace.llm.verify import BLOCK, maybe_sent, verified_links

BANDS, ROWS = 16, 4  # 1 - (1 - 0.8**4)**16 = 0.9998 of the pairs at the threshold collide
TOGETHER = 128  # texts of a bucket that one task compares; larger buckets go by a hub, then in blocks


def signatures(h: np.ndarray, many: np.ndarray) -> np.ndarray:
    """A hash of each text's words in their order; 0 for a text without any."""
    out = np.zeros(len(many), np.uint64)
    begin, some = np.cumsum(many) - many, many > 0
    if some.any():
        place = (np.arange(len(h)) - np.repeat(begin, many)).astype(np.uint64)
        out[some] = mixed(np.add.reduceat(mixed(h + mixed(place, 4), 5), begin[some]) + many[some].astype(np.uint64))
    return out.view(np.int64)


def bands_of(h: np.ndarray, many: np.ndarray) -> np.ndarray:
    """A row of band keys per text; zeros for those of fewer than SHINGLE words, which are near copies only if equal."""
    bands = np.zeros((len(many), BANDS), np.uint64)
    banded = np.flatnonzero(many >= SHINGLE)
    if len(banded):
        at, begin = _flat((np.cumsum(many) - many)[banded], many[banded] - SHINGLE + 1)
        own = _shingles(h)[at]
        for b in range(BANDS):
            key = np.full(len(banded), b, np.uint64)
            for r in range(ROWS):
                key = mixed(key * np.uint64(31) + np.minimum.reduceat(mixed(own, 1000 + b * ROWS + r), begin))
            bands[banded, b] = key
    return bands.view(np.int64)


def text_table(rows: DataFrame) -> DataFrame:
    """doc_id, row, sig (equal for texts of equal words), bands and fp (null for fewer than SHINGLE words) of every row."""

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in slices(batch["text"].str.len().fillna(0).astype(int).tolist(), PIECE):
                h, many = word_hashes(batch["text"].iloc[a:b].tolist())
                grams, begin = _shingles(h), np.cumsum(many) - many
                bands = [x if n >= SHINGLE else None for x, n in zip(bands_of(h, many), many)]
                fp = pd.array([majority(grams[x : x + n - SHINGLE + 1]) if n >= SHINGLE else None for x, n in zip(begin, many)], dtype="Int64")
                yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy()[a:b], "row": batch["row"].to_numpy()[a:b], "sig": signatures(h, many), "bands": bands, "fp": fp})
        give_back()

    return rows.mapInPandas(mark, "doc_id long, row long, sig long, bands array<long>, fp long")


def similar_links(rows: DataFrame, table: DataFrame, *, together: int = TOGETHER) -> DataFrame:
    """Links (a, b) between signatures whose components are those of all pairs of Jaccard SIMILAR that are candidates.

    Candidates share a band, or a component of close fingerprints. Buckets of the same texts are compared once.
    """
    distinct = written(table.where("bands is not null").groupBy("sig").agg(F.first("bands").alias("bands"), F.first("fp").alias("fp"), F.min("row").alias("row"), F.count(F.lit(1)).alias("c")), "distinct")
    close = written(connected_components(close_links(distinct.select("fp").distinct())), "close")
    by_print = distinct.select("sig", "row", "fp", "c").join(maybe_sent(close, close.count()), F.col("fp") == F.col("node"), "left").select("sig", "row", "c", F.xxhash64(F.coalesce("component", "fp"), F.lit("fp")).alias("key"))
    keyed = distinct.select("sig", "row", "c", F.explode("bands").alias("key")).unionAll(by_print)
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("sig")).alias("same"), F.min("sig").alias("lo")).where("n > 1")
    buckets = written(sizes.groupBy("n", "same", "lo").agg(F.min("key").alias("key")).select("key", "n"), "buckets")
    met = written(keyed.join(maybe_sent(buckets, buckets.count()), "key").select("key", "n", "sig", "row", "c"), "met")
    # A text weighs as many as it meets in all its buckets: the one that others were made from weighs most.
    central = met.groupBy("sig").agg(F.sum("n").alias("weight"))
    members = written(met.join(central, "sig").select("key", "n", "sig", "row", F.struct("weight", "c").alias("c")), "members")
    places = written(members.select("row").distinct(), "places")
    givers = rows.join(maybe_sent(places, places.count()), "row", "left_semi").select("text")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in slices(batch["text"].str.len().fillna(0).astype(int).tolist(), PIECE):
                h, many = word_hashes(batch["text"].iloc[a:b].tolist())
                grams, begin = _shingles(h).view(np.int64), np.cumsum(many) - many
                yield pd.DataFrame({"sig": signatures(h, many), "shingles": [np.unique(grams[x : x + n - SHINGLE + 1]) for x, n in zip(begin, many)]})
        give_back()

    bodies = written(givers.mapInPandas(sets, "sig long, shingles array<long>").dropDuplicates(["sig"]), "bodies")
    links = written(verified_links(members.select("key", "n", "sig", "c"), bodies, together=together, block=BLOCK), "similar")
    dropped(distinct, close, buckets, met, members, places, bodies)
    return links


def representatives(docs: DataFrame, *, key: str = "doc_id", text: str = "text", together: int = TOGETHER) -> DataFrame:
    """docs with one row per component of near copies: the least by (id, nulls last; hash of the text).

    Texts without a word are copies of one another. Rows that share an id but not a component all stay; copies
    without an id go like any others.
    """
    small_batches(docs.sparkSession)
    row = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(solid(key).alias("doc_id"), row.alias("row"), F.col(text).alias("text"))
    table = written(text_table(rows), "prints")
    links = written(connected_components(similar_links(rows, table, together=together)), "components")
    least = F.min(F.struct((F.col("doc_id") == NO_ID).alias("none"), "doc_id", "row")).alias("least")
    spots = table.groupBy("sig").agg(least)
    named = spots.join(links, spots["sig"] == links["node"], "left").groupBy(F.coalesce("component", "sig").alias("of")).agg(F.min("least").alias("least"))
    keep = written(named.select(F.col("least.doc_id").alias("_keep"), F.col("least.row").alias("_row")), "kept")
    marked = docs.withColumns({"_id": solid(key), "_hash": row})
    kept = marked.join(keep, (F.col("_id") == F.col("_keep")) & (F.col("_hash") == F.col("_row")), "left_semi")
    return kept.dropDuplicates(["_id", "_hash"]).select(docs.columns)
