"""A Bloom filter of a table's keys: what a large table has none of leaves before it is shuffled for a join.

It is blocked: all bits of a key lie in one block of 4 KB, so the keys are dealt by block and every task makes blocks of
its own. The driver puts them together, MOST bits at most, and sends them out. Keys are hashes already. A filter lets
rows through that have no partner, never the other way round: the join stays as it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import give_back, mixed

BLOCK_BITS = 1 << 15
PER_KEY = 16  # bits: 0.3 % of the other keys pass; beyond 2**25 keys more of them do
MOST = 1 << 29
PROBES = 4
TOGETHER = 500_000  # keys of a task


def _bits(keys: np.ndarray, block: np.ndarray) -> Iterator[np.ndarray]:
    """The places of each key's PROBES bits, if its block is the one given."""
    h = mixed(keys.view(np.uint64), 6)
    for k in range(PROBES):
        yield block * BLOCK_BITS + (h >> np.uint64(15 * k) & np.uint64(BLOCK_BITS - 1)).astype(np.int64)


class Bits:
    """What the workers get of a filter."""

    def __init__(self, blocks: np.ndarray):
        self.blocks = blocks  # a row of bytes each

    def holds(self, keys: np.ndarray) -> np.ndarray:
        flat, found = self.blocks.reshape(-1), np.ones(len(keys), bool)
        for at in _bits(keys, np.mod(keys, np.int64(len(self.blocks)))):
            found &= (flat[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return found


class Sieve:
    """The filter of one column of hashes (long) of a table whose rows were counted."""

    def __init__(self, table: DataFrame, key: str | Column, rows: int):
        n = max(1, -(-min(MOST, PER_KEY * rows) // BLOCK_BITS))

        def filled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            keys = np.concatenate([np.empty(0, np.int64), *(b["key"].to_numpy() for b in batches)])
            blocks, own = np.unique(np.mod(keys, np.int64(n)), return_inverse=True)
            bits = np.zeros(len(blocks) * BLOCK_BITS, bool)
            for at in _bits(keys, own.astype(np.int64)):
                bits[at] = True
            yield pd.DataFrame({"block": blocks, "bits": [x.tobytes() for x in np.packbits(bits.reshape(-1, BLOCK_BITS), axis=1, bitorder="little")]})
            give_back()

        keys = table.select((F.col(key) if isinstance(key, str) else key).alias("key"))
        found = keys.repartition(-(-rows // TOGETHER) or 1, F.pmod("key", F.lit(n))).mapInPandas(filled, "block long, bits binary").toArrow()
        blocks = np.zeros((n, BLOCK_BITS // 8), np.uint8)
        for block, bits in zip(found.column("block").to_pylist(), found.column("bits").to_pylist()):
            blocks[block] = np.frombuffer(bits, np.uint8)
        self.sent = table.sparkSession.sparkContext.broadcast(Bits(blocks))

    def holds(self, key: str | Column) -> Column:
        """Whether the key may be in the table."""
        sent = self.sent

        @F.pandas_udf("boolean")
        def held(keys: pd.Series) -> pd.Series:
            return pd.Series(sent.value.holds(keys.to_numpy()))

        return held(key)
