"""Column profiles in one pass: counts and, per column, the distinct values of lowest hash."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import r6
from millrace.session import ship

KEPT = 1024  # values a column keeps; with fewer, its number of distinct values is exact, with more an estimate (about 3 % off)


def column_profile(df: DataFrame, cols: list[str], *, kept: int = KEPT, shown: int = 5, most_null: float = 95.0) -> DataFrame:
    """column, total, non_blank, null_pct, distinct_values, exact, samples and decision, one row per column.

    Values are trimmed text; blank counts as null. Samples are the `shown` values of lowest MD5, so they depend on the
    values alone, not on partitioning or repeats. distinct_values is exact below `kept`, else estimated from the hash
    of place `kept`. The decision is "empty" above `most_null` per cent of nulls or with one value at most (both exact),
    else "keep"; a table without rows has 0 per cent and is "keep", as no row speaks against it. Every partition sends
    at most `kept` values per column, of which Spark keeps `kept` before the shuffle.
    """
    if kept < 2 or shown > kept:
        raise ValueError("two values at least, and all that are shown, must be kept")
    ship(df.sparkSession)
    places = range(len(cols))
    texts = df.select(*[F.nullif(F.btrim(F.col(c).cast("string")), F.lit("")).alias(str(i)) for i, c in enumerate(cols)])

    def local(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, filled, lowest = 0, [0] * len(cols), [{} for _ in cols]
        for pdf in parts:
            rows += len(pdf)
            for i in places:
                x = pdf[str(i)].dropna()
                filled[i] += len(x)
                known = lowest[i]
                known.update((hashlib.md5(v.encode("utf-8", "replace")).hexdigest(), v) for v in x.unique())
                if len(known) > kept:
                    lowest[i] = {h: known[h] for h in sorted(known)[:kept]}
        yield pd.DataFrame({"place": list(places), "total": rows, "non_blank": filled, "hash": [list(d) for d in lowest], "value": [list(d.values()) for d in lowest]})

    found = texts.mapInPandas(local, "place int, total long, non_blank long, hash array<string>, value array<string>")
    # one row of counts and up to `kept` rows of values per partition and column, in one frame, so that the table is read once
    flat = found.select("place", F.explode(F.concat(F.array(F.struct(F.lit("").alias("hash"), F.lit("").alias("value"), F.col("total"), F.col("non_blank"))), F.transform(F.arrays_zip("hash", "value"), lambda x: F.struct(x["hash"].alias("hash"), x["value"].alias("value"), F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("non_blank"))))).alias("x")).select("place", "x.*")
    merged = flat.groupBy("place", "hash", "value").agg(F.sum("total").alias("total"), F.sum("non_blank").alias("non_blank"))
    first = merged.withColumn("_n", F.row_number().over(Window.partitionBy("place").orderBy("hash"))).where(F.col("_n") <= kept + 1)
    by = first.groupBy("place").agg(F.sum("total").alias("total"), F.sum("non_blank").alias("non_blank"), (F.count(F.lit(1)) - 1).alias("n"), F.max("hash").alias("last"), F.sort_array(F.collect_list(F.when((F.col("_n") > 1) & (F.col("_n") <= shown + 1), F.struct("_n", "value")))).alias("few"))
    share = F.when(F.col("total") > 0, 100.0 * (F.col("total") - F.col("non_blank")) / F.col("total")).otherwise(0.0)
    below = F.conv(F.substring("last", 1, 12), 16, 10).cast("double") / float(16**12)  # where the last kept hash lies in [0, 1)
    distinct = F.when(F.col("n") < kept, F.col("n")).otherwise(F.round((kept - 1) / below).cast("long"))
    stats = by.select("place", "total", "non_blank", r6(share).alias("null_pct"), distinct.alias("distinct_values"), (F.col("n") < kept).alias("exact"), F.transform("few", lambda x: x["value"]).alias("samples"), F.when((share > most_null) | ((F.col("n") <= 1) & (F.col("total") > 0)), "empty").otherwise("keep").alias("decision"))
    names = df.sparkSession.createDataFrame(list(enumerate(cols)), "place int, column string")
    none = {"total": 0, "non_blank": 0, "null_pct": 0.0, "distinct_values": 0, "exact": True, "decision": "keep"}
    return names.join(stats, "place", "left").na.fill(none).withColumn("samples", F.coalesce("samples", F.array().cast("array<string>"))).drop("place")


def columns_to_load(profile: DataFrame, most_null: float = 95.0, least_values: int = 2) -> DataFrame:
    """The columns worth loading: at most `most_null` per cent of nulls and `least_values` different values or more."""
    return profile.where((F.col("null_pct") <= most_null) & (F.col("distinct_values") >= least_values)).select("column")
