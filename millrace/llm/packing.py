"""Packing token sequences by minimum bin slack.

Documents are cut into full windows and one remainder each. Only the histogram of piece lengths is needed to decide
which lengths share a window: a bitset subset-sum over the multiset of remaining lengths finds, for the longest
length left, the fill closest to capacity; the counts of the fill are traced back through the bitsets, and the fill is
repeated as long as the counts last. The plan has a few rows per length, whatever the corpus. Pieces then take
their places by their rank among pieces of equal length, computed over salted buckets.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import give_back, or_null, small_batches, solid, written

CAPACITY = 2048
RANK_ROWS = 200_000  # pieces of a bucket, of all lengths together, on average


# --- tokens ---------------------------------------------------------------------------------------------------------


KNOWN_PIECES = 250_000  # word pieces whose ids a worker remembers; the memory starts anew when it is full
# Characters that lower-case one by one and that no normalisation joins: ASCII and the Latin-1 letters.
PLAIN = re.compile("[\\x00-\\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
# The split of the word tokenizers, over plain lower-case text.
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^ \\t\\n\\x0b\\x0c\\r{LETTERS}0-9]+")
PROBE = "The don't-we'll \u00c9t\u00e9's 2024,\x1c(gro\u00dfe) <| x\x0by..."


class _Coder:
    """Ids of texts; a piece that came before is not looked up again.

    Plain text is cut by PIECES here and only unknown pieces go to the tokenizer's model; other text, and text that
    holds the literal of an added token, takes the whole tokenizer. A tokenizer that cuts PROBE another way than PIECES always takes the second way.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        added = [t.content for t in self.whole.get_added_tokens_decoder().values() if t.content]
        self.added = re.compile("|".join(map(re.escape, added)), re.I) if added else None  # such literals are single tokens
        same = {*range(33, 127), *range(161, 173), *range(174, 256)}  # bytes that stand for themselves in byte-level models
        others = [b for b in range(256) if b not in same]
        self.byte_sign = {b: 256 + i for i, b in enumerate(others)}
        self.known: dict[str, bytes] = {}
        self.quick = True
        try:
            self.quick = self.ids(PROBE) == self._slow(PROBE)
        except Exception:  # a model of another kind need not take single pieces
            self.quick = False

    def _slow(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if not self.quick or not PLAIN.fullmatch(text) or (self.added and self.added.search(text)):
            return self._slow(text)
        pieces, known = PIECES.findall(text.lower()), self.known
        try:
            return b"".join([known[p] for p in pieces])
        except KeyError:
            new = [p for p in dict.fromkeys(pieces) if p not in known]
        if len(known) + len(new) > KNOWN_PIECES:
            known.clear()
            new = dict.fromkeys(pieces)
        tokenize, signs = self.whole.model.tokenize, self.byte_sign
        for p in new:
            known[p] = np.array([x.id for x in tokenize(p.encode().decode("latin-1").translate(signs))], dtype="<u4").tobytes()
        return b"".join([known[p] for p in pieces])


@lru_cache(maxsize=2)
def _coder(path: str) -> _Coder:
    return _Coder(path)


def _ids(path: str, texts: list[str], end_id: int) -> Iterator[bytes]:
    """Little-endian 32-bit ids of every text and the end id."""
    coder, end = _coder(path), np.array([end_id], dtype="<u4").tobytes()
    for text in texts:
        yield coder.ids(text) + end


def token_pieces(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", end_id: int = 1, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Cut the token ids of every document, an end id after them, into pieces of at most `capacity`.

    One row per piece: key, start (ids of the document before it), length, ids_crc32 of its little-endian ids,
    doc_tokens, and the ids themselves unless with_ids is off. Null text counts as empty: one piece with the end id.
    """
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        for batch in batches:
            rows = []
            for doc, ids in zip(batch["doc_id"], _ids(tokenizer, [t or "" for t in batch["text"]], end_id)):
                for start in range(0, len(ids), 4 * capacity):
                    part = ids[start : start + 4 * capacity]
                    rows.append((doc, start // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4, *([np.frombuffer(part, "<i4")] if with_ids else [])))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
        give_back()

    small_batches(docs.sparkSession)
    found = docs.select(solid(key).alias("doc_id"), F.col(text).alias("text")).mapInPandas(cut, schema)
    return found.withColumn("doc_id", or_null("doc_id"))


# --- the plan -------------------------------------------------------------------------------------------------------


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths within counts whose sum comes closest to room, from below; it prefers long pieces."""
    reach, steps = 1, []
    full = (1 << (room + 1)) - 1
    for length in sorted((n for n, c in counts.items() if c > 0 and n <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left > 0:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & full
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    aim, fill = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> aim & 1:  # aim can't be made without this step
            fill[length] = fill.get(length, 0) + take
            aim -= length * take
    return fill


def plan_fills(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(fill, number of windows) pairs that use up the histogram. Each pair exhausts a length at least or halves it."""
    counts, plan = {n: c for n, c in histogram.items() if c > 0}, []
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        fill = best_fill(counts, capacity - longest)
        counts[longest] += 1
        fill[longest] = fill.get(longest, 0) + 1
        times = min(counts[n] // c for n, c in fill.items())
        plan.append((fill, times))
        for n, c in fill.items():
            counts[n] -= c * times
            if not counts[n]:
                del counts[n]
    return plan


def _placements(plan: list[tuple[dict[int, int], int]]) -> pd.DataFrame:
    """One row per (fill, length): the ranks of that length that it holds, and where they stand."""
    used: dict[int, int] = {}
    rows, window = [], 0
    for fill, times in plan:
        at = 0
        for length in sorted(fill, reverse=True):
            each = fill[length]
            rows.append((length, used.get(length, 0), each, window, at))
            used[length] = used.get(length, 0) + each * times
            at += each * length
        window += times
    return pd.DataFrame(rows, columns=["length", "first_rank", "each", "first_window", "at"])


def pack(pieces: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """Give every piece (doc_id, start, length, ...) its sequence_id and its offset there.

    The histogram on the driver and the plan have at most a few thousand rows, bounded by capacity. Ranks within a
    length are counted per salted bucket and shifted by the counts of the buckets before, so a length that a third
    of all pieces have is spread as well. Repeated rows each get their own place. An empty table gives no rows.
    """
    spark = pieces.sparkSession
    spans = written(pieces, "pieces")
    histogram = {r["length"]: r["n"] for r in spans.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    salts = max(16, sum(histogram.values()) // RANK_ROWS)
    salted = spans.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)).cast("int"))
    before = (
        salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .drop("_n")
    )
    rank = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "start", "ids_crc32")) - 1
    ranked = salted.withColumn("_in", rank).join(F.broadcast(before) if salts * capacity <= 200_000 else before, ["length", "_salt"]).withColumn("_rank", F.col("_before") + F.col("_in"))
    places = _placements(plan_fills(histogram, capacity))
    ends = places.groupby("length")["first_rank"].apply(list).to_dict()
    table = {n: g.reset_index(drop=True) for n, g in places.groupby("length")}
    shipped = spark.sparkContext.broadcast({n: (np.array(ends[n]), g[["each", "first_window", "at"]].to_numpy(np.int64)) for n, g in table.items()})

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(length), 2), dtype=np.int64)
        n, r = length.to_numpy(), rank.to_numpy()
        order = np.argsort(n, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(n[order])) + 1) if len(order) else []:
            firsts, rows = shipped.value[int(n[at[0]])]
            k = np.searchsorted(firsts, r[at], side="right") - 1
            within = r[at] - firsts[k]
            each, window, start = rows[k].T
            out[at, 0], out[at, 1] = window + within // each, start + within % each * n[at]
        return pd.DataFrame(out, columns=["sequence_id", "offset"])

    placed = ranked.withColumn("_place", place("length", "_rank"))
    return placed.select(*spans.columns, F.col("_place.sequence_id").alias("sequence_id"), F.col("_place.offset").alias("offset"))


def sequences(packed: DataFrame, *, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """The training rows: sequence_id, ids, n_tokens. Padded to capacity, except at a power of two."""
    ordered = packed.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
    n = F.size("ids")
    pad = F.when(F.expr("bit_count(size(ids)) = 1"), 0).otherwise(F.lit(capacity) - n)
    return ordered.select("sequence_id", F.concat("ids", F.array_repeat(F.lit(pad_id), pad)).alias("ids"), n.alias("n_tokens"))
