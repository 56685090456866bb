"""Chunks without a heartbeat: a stateful stream with event-time timers, and the same rule over a table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SPELL = "chunk_id long, last_heartbeat timestamp, stale_at timestamp"
GROUPS = 1024  # of chunks; a group's unsettled heartbeats, at 17 bytes each, are read and written at once
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def thinned(times: np.ndarray, ended: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct heartbeats without those that can't matter: both neighbours lie within one limit of each other.

    Such a heartbeat has a successor in time, and whatever it succeeds in time has its right neighbour as well. What is
    left is at most two per limit of time, however dense the heartbeats are. Of equal times, one that ends the chunk wins.
    """
    return thinned_by(np.zeros(len(times), np.int64), times, ended, limit)[1:]


def thinned_by(ids: np.ndarray, times: np.ndarray, ended: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for the heartbeats of many chunks at once. Of heartbeats in a row that could go, every second one goes, until none can."""
    order = np.lexsort((~ended, times, ids))
    ids, times, ended = ids[order], times[order], ended[order]
    first = np.ones(len(times), bool)
    first[1:] = (times[1:] != times[:-1]) | (ids[1:] != ids[:-1])
    ids, times, ended = ids[first], times[first], ended[first]
    while len(times) > 2:
        spare = np.zeros(len(times), bool)
        spare[1:-1] = (ids[2:] == ids[:-2]) & (times[2:] - times[:-2] <= limit)
        if not spare.any():
            break
        place = np.arange(len(times))
        begin = np.maximum.accumulate(np.where(spare, -1, place))  # the last heartbeat before the row that stays
        keep = ~(spare & ((place - begin) % 2 == 1))
        ids, times, ended = ids[keep], times[keep], ended[keep]
    return ids, times, ended


_KEPT = np.dtype([("id", "<i8"), ("time", "<i8"), ("ended", "?")])
WAITING = 100_000  # heartbeats that are added to a group before it is thinned


class StaleChunks(StatefulProcessor):
    """Per group of chunks the heartbeats that the watermark has not settled; one timer, at the end of the first open gap.

    When it expires, all heartbeats up to the watermark have arrived, so all that lack a successor within the limit by
    then are stale spells: they are settled in one call, and the timer is set anew. A call costs milliseconds, whatever
    it settles, so there is none per spell. Restarts take state and timers from the checkpoint.
    """

    def __init__(self, limit_us: int):
        self.limit = limit_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("heartbeats", "packed binary")

    def _state(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = np.frombuffer(bytes(self.kept.get()[0]), _KEPT) if self.kept.exists() else np.empty(0, _KEPT)
        return rows["id"].copy(), rows["time"].copy(), rows["ended"].copy()

    def _keep(self, ids: np.ndarray, times: np.ndarray, ended: np.ndarray) -> None:
        """Write the state, and set the timer at the first end of an open gap. A chunk's last heartbeat has one even if it
        ends the chunk, to clear the state."""
        if not len(ids):
            self.kept.clear()
            return
        rows = np.empty(len(ids), _KEPT)
        rows["id"], rows["time"], rows["ended"] = ids, times, ended
        self.kept.update((rows.tobytes(),))
        last = np.append(ids[1:] != ids[:-1], True)
        end = times[last | self._gaps(times, ended, ids)].min() + self.limit
        self.handle.registerTimer(int(-(-end // 1000)))

    def _gaps(self, times: np.ndarray, ended: np.ndarray, ids: np.ndarray | None = None) -> np.ndarray:
        alone = np.ones(len(times), bool)
        alone[:-1] = times[1:] - times[:-1] > self.limit
        if ids is not None:
            alone[:-1] |= ids[1:] != ids[:-1]
        return ~ended & alone

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kept, new = self._state(), []
        for part in rows:
            new.append((part["chunk_id"].to_numpy(np.int64), part["at_us"].to_numpy(np.int64), part["ended"].to_numpy(bool)))
            if sum(len(x[0]) for x in new) > max(WAITING, len(kept[0])):
                kept, new = thinned_by(*map(np.concatenate, zip(kept, *new)), self.limit), []
        self._keep(*thinned_by(*map(np.concatenate, zip(kept, *new)), self.limit))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ids, times, ended = self._state()
        due = times + self.limit <= timerValues.getCurrentWatermarkInMs() * 1000
        stale = self._gaps(times, ended, ids) & due
        self._keep(ids[~due], times[~due], ended[~due])
        if stale.any():
            at = lambda us: pd.to_datetime(us, unit="us", utc=True)
            yield pd.DataFrame({"chunk_id": ids[stale], "last_heartbeat": at(times[stale]), "stale_at": at(times[stale] + self.limit)})


def heartbeats(df: DataFrame, chunk: str, at: str, ended) -> DataFrame:
    """(chunk_id, heartbeat_at, ended); rows without a chunk or a time say nothing. An unknown `ended` is false."""
    rows = df.select(F.col(chunk).cast("long").alias("chunk_id"), F.col(at).cast("timestamp").alias("heartbeat_at"), F.coalesce(ended, F.lit(False)).alias("ended"))
    return rows.where("chunk_id is not null and heartbeat_at is not null")


def stale_stream(spark: SparkSession, source: str, schema, chunk: str, at: str, ended, limit_s: int, late_s: int, target: str, checkpoint: str, files_per_batch: int = 16, groups: int = GROUPS) -> DataFrame:
    """Stale spells of a folder of files of heartbeats, appended to target; reads what is there and stops.

    A heartbeat that comes later than late_s behind the greatest one seen may be dropped, so late_s must cover the files'
    disorder; then any order and any split into batches give the rows of stale_spells. Chunks are dealt to so many groups
    by hash; a checkpoint holds for one number. Runs in a session of its own, since timers need the RocksDB state store.
    """
    own = spark.newSession()
    for name, value in (("spark.sql.streaming.stateStore.providerClass", ROCKS), ("spark.sql.session.timeZone", "UTC"), ("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))):
        own.conf.set(name, value)
    rows = heartbeats(own.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source), chunk, at, ended)
    marked = rows.withWatermark("heartbeat_at", f"{late_s} seconds").withColumns({"at_us": F.unix_micros("heartbeat_at"), "_group": F.pmod(F.xxhash64("chunk_id"), F.lit(groups))})
    out = marked.groupBy("_group").transformWithStateInPandas(StaleChunks(limit_s * 1_000_000), SPELL, "Append", "EventTime")
    out.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(SPELL).parquet(target)


def stale_spells(df: DataFrame, chunk: str, at: str, ended, limit_s: int, late_s: int = 0) -> DataFrame:
    """(chunk_id, last_heartbeat, stale_at): heartbeats that neither end the chunk nor have a successor within the limit.

    Only spells that are over the limit at the table's greatest time less late_s count, in whole milliseconds.
    """
    rows = heartbeats(df, chunk, at, ended).groupBy("chunk_id", "heartbeat_at").agg(F.bool_or("ended").alias("ended"))
    end = rows.agg((F.date_trunc("millisecond", F.max("heartbeat_at")) - F.make_dt_interval(secs=F.lit(late_s))).alias("_end"))
    stale_at = F.col("heartbeat_at") + F.make_dt_interval(secs=F.lit(limit_s))
    following = F.lead("heartbeat_at").over(Window.partitionBy("chunk_id").orderBy("heartbeat_at"))
    spells = rows.withColumns({"stale_at": stale_at, "_next": following}).join(F.broadcast(end))  # one row
    over = ~F.col("ended") & (F.col("_next").isNull() | (F.col("_next") > F.col("stale_at"))) & (F.col("stale_at") <= F.col("_end"))
    return spells.where(over).select("chunk_id", F.col("heartbeat_at").alias("last_heartbeat"), "stale_at")
