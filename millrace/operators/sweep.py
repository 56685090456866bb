"""Running totals over sorted events, spread over range partitions, and what follows from them: rows in ranges of any
width, and how many operations are open at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stored


def running_total(events: DataFrame, order: list[str], value: str, name: str = "running") -> DataFrame:
    """events with the sum of value (long, no nulls) over all rows up to and with this one, in the order of these columns.

    Events are range partitioned and sorted; a task adds up its own range and writes it; the totals of the ranges before
    are added afterwards. Rows that tie in `order` follow one another in any order, on one partition or several.
    """
    tied = events.withColumn("_tie", F.monotonically_increasing_id())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            sums = total + np.cumsum(batch.column(batch.schema.get_field_index(value)).to_numpy())
            total = int(sums[-1]) if len(sums) else total
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.int64())], names=[*batch.schema.names, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in events.schema)
    ranged = tied.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie").withColumn("_part", F.spark_partition_id())
    summed = stored(ranged.mapInArrow(add, f"{schema}, _part int, {name} long"), "running")
    totals = summed.groupBy("_part").agg(F.sum(value).alias("_sum"))  # a row per partition
    before = totals.select("_part", F.coalesce(F.sum("_sum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return summed.join(before, "_part").withColumn(name, F.col(name) + F.col("_before")).drop("_part", "_before")


def count_in_ranges(ranges: DataFrame, rows: DataFrame, key: str, range_id: list[str], lo: str = "lo", hi: str = "hi") -> DataFrame:
    """ranges (told apart by range_id) with `rows`: how many rows have their key in [lo, hi); 0 if there is none or hi <= lo.

    Range ends and keys are merged in one order: the rows before hi less those before lo. The work does not depend on
    the width of the ranges or on how they overlap. Equal keys are counted before they are merged. Ranges with a null
    end have null rows, null keys are in no range.
    """
    ends = [ranges.where(F.col(lo).isNotNull() & F.col(hi).isNotNull()).select(*range_id, F.col(c).cast("long").alias("_at"), F.lit(s).alias("_side"), F.lit(0).cast("long").alias("_n")) for c, s in ((lo, -1), (hi, 1))]
    keys = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("_at")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_side", F.lit(2))  # after the ends at the same key
    events = ends[0].unionByName(ends[1]).unionByName(keys, allowMissingColumns=True)
    total = running_total(events.select(*[F.col(c).alias(f"_id_{i}") for i, c in enumerate(range_id)], "_at", "_side", "_n"), ["_at", "_side"], "_n")
    found = total.where("_side < 2").groupBy(*[f"_id_{i}" for i in range(len(range_id))]).agg(F.greatest(F.sum(F.col("_side") * F.col("running")), F.lit(0)).cast("long").alias("rows"))
    same = [ranges[c].eqNullSafe(found[f"_id_{i}"]) for i, c in enumerate(range_id)]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return ranges.join(found, on, "left").drop(*[f"_id_{i}" for i in range(len(range_id))])


def open_levels(spans: DataFrame, start: str, end: str) -> DataFrame:
    """(moment, started, ended, open): at every start and end, how many spans [start, end) are open from then on.

    Spans that end at their start, or before it, or lack an end, are never open. A row per instant, however many spans meet there.
    """
    real = spans.where(F.col(start) < F.col(end))
    mark = lambda c, s, e: F.struct(F.col(c).alias("moment"), F.lit(s).alias("_s"), F.lit(e).alias("_e"))
    marks = real.select(F.inline(F.array(mark(start, 1, 0), mark(end, 0, 1))))
    events = marks.groupBy("moment").agg(F.sum("_s").alias("started"), F.sum("_e").alias("ended")).withColumn("_change", F.col("started") - F.col("ended"))
    return running_total(events, ["moment"], "_change", "open").drop("_change")


def peaks_by_day(levels: DataFrame) -> DataFrame:
    """(day, most_open): the highest level on every day with a start or an end, what was open at midnight included.

    levels: (moment, open). A day's first level before its first mark is the last one before, found per day and not per row.
    """
    day = F.to_date("moment")
    own = levels.groupBy(day.alias("day")).agg(F.max("open").alias("_top"), F.max_by("open", "moment").alias("_last"))
    carried = F.coalesce(F.lag("_last").over(Window.orderBy("day")), F.lit(0))  # a row per day
    first = levels.groupBy(day.alias("day")).agg(F.min("moment").alias("_first")).select("day", (F.col("_first") > F.col("day").cast("timestamp_ntz")).alias("_later"))
    return own.withColumn("_before", carried).join(first, "day").select("day", F.when(F.col("_later"), F.greatest("_top", "_before")).otherwise(F.col("_top")).alias("most_open"))


def long_running(spans: DataFrame, start: str, end: str, seconds: float, as_of: Column) -> DataFrame:
    """spans that took, or have taken at as_of, longer than so many seconds; `seconds` tells how long."""
    took = (F.unix_micros(F.coalesce(end, as_of).cast("timestamp")) - F.unix_micros(F.col(start).cast("timestamp"))) / 1e6
    return spans.withColumn("seconds", took).where(F.col("seconds") > seconds)
