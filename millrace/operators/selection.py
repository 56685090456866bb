"""Values at an exact rank, found by narrowing histograms: no group is sorted or gathered in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stored

BINS = 1024
FEW = 10_000  # values of a bin that one task may sort
ALONE = 200_000  # the same where there is one group only


def value_at(df: DataFrame, col: str, share: float, keys: list[str], *, bins: int = BINS, few: int = FEW) -> DataFrame:
    """keys and value: per key the value at place floor(n * share), at most n - 1, of the n ascending values, from 0.

    Nulls and NaN are left out; keys without a value have no row; infinities count as values. A pass counts the values of every key that can
    still be it in `bins` bins between their least and greatest, and keeps the bin that holds the rank. A key is done
    when its bin holds one value only; a bin of up to `few` values is sorted.
    """
    x = F.col(col).cast("double")
    marks = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)] or [F.lit(0).alias("_k0")]
    rows = df.select(*marks, x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    names = [f"_k{i}" for i in range(len(marks))]
    open_ = stored(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")).withColumn("_rank", F.least(F.floor(F.col("_n") * share), F.col("_n") - 1)), "ranks")
    done = []
    while True:
        done.append(open_.where("_lo = _hi").select(*names, F.col("_lo").alias("_value")))
        small = open_.where((F.col("_lo") < F.col("_hi")) & (F.col("_n") <= few))
        done.append(_within(rows, small, names).groupBy(*names).agg(F.get(F.sort_array(F.collect_list("_x")), F.first("_rank").cast("int")).alias("_value")))
        large = open_.where((F.col("_lo") < F.col("_hi")) & (F.col("_n") > few))
        if not large.limit(1).count():
            break
        # halves first, so that the width of a range is finite; the ends have bins of their own, infinite ones too
        place = (F.col("_x") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
        bin_ = F.when(F.col("_x") == F.col("_lo"), 0).when(F.col("_x") == F.col("_hi"), bins + 1).otherwise(F.least(F.lit(bins), 1 + F.floor(F.when(F.isnan(place), 0.5).otherwise(place) * bins)).cast("int"))
        counts = _within(rows, large, names).groupBy(*names, bin_.alias("_bin")).agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.first("_rank").alias("_rank"))
        before = F.sum("_n").over(Window.partitionBy(*names).orderBy("_bin")) - F.col("_n")  # at most bins + 2 rows a key
        kept = counts.withColumn("_before", before).where((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_n")))
        open_ = stored(kept.select(*names, "_n", "_lo", "_hi", (F.col("_rank") - F.col("_before")).alias("_rank")), "ranks")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], F.col("_value").alias("value"))


def quantile(df: DataFrame, col: str, share: float) -> float:
    """The quantile of a column, linear between the two values around it; nulls and NaN are left out, no value: 0."""
    n = df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double"))).count()
    if not n:
        return 0.0
    at = (n - 1) * share
    low = int(at)
    value = value_at(df, col, (low + 0.5) / n, [], few=ALONE).first()["value"]  # the middle of a rank's share is safe from rounding
    if at == low:
        return value
    x = F.col(col).cast("double")
    around = df.where(x.isNotNull() & ~F.isnan(x)).agg(F.count_if(x <= value).alias("upto"), F.min(F.when(x > value, x)).alias("above")).first()
    return value + (at - low) * ((value if around["upto"] > low + 1 else around["above"]) - value)


def _within(rows: DataFrame, bounds: DataFrame, names: list[str]) -> DataFrame:
    """The rows that lie between their key's bounds, with these; bounds have a row per key, so a hot key is no hot join."""
    ends = bounds.select(*[F.col(n).alias(f"{n}_b") for n in names], "_rank", "_lo", "_hi")
    on = F.lit(True)
    for n in names:
        on = on & rows[n].eqNullSafe(ends[f"{n}_b"])
    return rows.join(ends, on).where("_x >= _lo and _x <= _hi").drop(*[f"{n}_b" for n in names])
