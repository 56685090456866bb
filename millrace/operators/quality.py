"""Data quality checks, reconciliation, schema drift and lineage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import saved



def _checks(rows: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), rows)


def quality_checks(df: DataFrame, key: str, required: list[str], min_rows: int, max_null_pct: float = 0.0) -> DataFrame:
    """name, passed, details: not empty, row count, duplicate keys (groups and extra rows), null share of required columns.

    A null share fails only strictly above the limit; an empty table passes it. One pass, and one by key.
    """
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required]
    one = df.agg(F.count("*").alias("n"), *nulls)
    dup = df.groupBy(key).agg(F.count("*").alias("c")).where("c > 1").agg(F.count("*").alias("groups"), F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("extra"))
    row = one.crossJoin(dup)
    text = lambda *cols: F.concat_ws("/", *[F.col(c).cast("string") for c in cols])
    found = [F.struct(F.lit("not_empty").alias("name"), (F.col("n") > 0).alias("passed"), text("n").alias("details")), F.struct(F.lit("min_rows").alias("name"), (F.col("n") >= min_rows).alias("passed"), text("n").alias("details")), F.struct(F.lit("no_duplicates").alias("name"), (F.col("groups") == 0).alias("passed"), text("groups", "extra").alias("details"))]
    for c in required:
        share = F.when(F.col("n") > 0, 100.0 * F.col(f"null_{c}") / F.col("n")).otherwise(0.0)
        found.append(F.struct(F.lit(f"null_rate_{c}").alias("name"), (share <= max_null_pct).alias("passed"), text(f"null_{c}").alias("details")))
    return row.select(F.inline(F.array(*found)))


def check_summary(checks: DataFrame) -> DataFrame:
    return checks.agg(F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"), F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"))


def key_quality(df: DataFrame, key: str) -> DataFrame:
    x = F.btrim(F.col(key))
    digits = x.rlike("^[0-9]+$")
    value = F.when(digits, x.try_cast("bigint"))
    return df.agg(F.count("*").alias("total"), F.count_if(F.col(key).isNull()).alias("nulls"), F.count_if(x == "").alias("blanks"), F.count_if((x != "") & ~digits).alias("non_numeric"), F.count_if(digits & (F.length(x) > 19)).alias("too_long"), F.min(value).alias("min_key"), F.max(value).alias("max_key"), F.coalesce(F.max(value) > 2147483647, F.lit(False)).alias("exceeds_int"))


def fixed_width_gate(df: DataFrame, key: str) -> DataFrame:
    """Text ranges by this key are safe only if every key is digits of one length."""
    x = F.col(key)
    bad = F.count_if(x.isNull() | (F.btrim(x) == "") | ~F.coalesce(x.rlike("^[0-9]+$"), F.lit(False)))
    return df.agg(bad.alias("bad_keys"), F.min(F.length(x)).alias("min_length"), F.max(F.length(x)).alias("max_length")).withColumn("passed", (F.col("bad_keys") == 0) & F.coalesce(F.col("min_length") == F.col("max_length"), F.lit(True)))


def castable_gate(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Per column, non-blank values that the type can't take."""
    counts = []
    for c, t in types.items():
        x = F.nullif(F.btrim(F.col(c)), F.lit(""))
        counts.append(F.struct(F.lit(c).alias("column"), F.count(x).alias("filled"), F.count_if(x.isNotNull() & x.try_cast(t).isNull()).alias("failing")))
    return df.agg(F.array(*counts).alias("r")).select(F.inline("r"))


def cast_failures(df: DataFrame, col: str, to: str, order: str, limit: int) -> DataFrame:
    x = F.nullif(F.btrim(F.col(col)), F.lit(""))
    return df.where(x.isNotNull() & x.try_cast(to).isNull()).select(order, col).orderBy(order).limit(limit)


def validate_target(df: DataFrame, keys: list[str]) -> DataFrame:
    groups = df.groupBy(*keys).agg(F.count("*").alias("c"))
    return groups.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("rows"), F.count_if(F.col("c") > 1).alias("duplicate_groups"))


def key_stats(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.countDistinct(key).alias("distinct_keys"), F.min(key).alias("min_key"), F.max(key).alias("max_key"), F.count_if(F.col(key).isNull()).alias("null_keys"))


def range_stats(df: DataFrame, key: str, size: int) -> DataFrame:
    """Rows and distinct keys per range of `size` keys from the least one on, empty ranges included."""
    ends = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    bucket = F.floor((F.col(key) - F.col("lo")) / size)
    counted = df.where(F.col(key).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(bucket.alias("range_no")).agg(F.count("*").alias("rows"), F.countDistinct(key).alias("distinct_keys"))
    ranges = ends.where("lo is not null").select(F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("hi") - F.col("lo")) / size))).alias("range_no"))
    return ranges.join(counted, "range_no", "left").na.fill(0)


def reconcile(raw: DataFrame, dds: DataFrame, key: str, check_extra: bool = True) -> DataFrame:
    """One row of counts with the verdict RECONCILED or REVIEW_REQUIRED; one full join of the two key counts."""
    a = raw.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("raw_rows"))
    b = dds.groupBy(F.col(key).alias("k2")).agg(F.count("*").alias("dds_rows"))
    j = a.join(b, F.col("k").eqNullSafe(F.col("k2")), "full_outer")
    has = F.coalesce("k", "k2").isNotNull()
    n = j.agg(F.count_if(has & F.col("raw_rows").isNotNull()).alias("raw_distinct"), F.coalesce(F.sum("dds_rows"), F.lit(0)).alias("target_rows"), F.coalesce(F.sum(F.when(~has, F.col("dds_rows"))), F.lit(0)).alias("null_keys"), F.count_if(has & (F.col("dds_rows") > 1)).alias("duplicate_groups"), F.count_if(has & F.col("dds_rows").isNull()).alias("missing"), F.count_if(has & F.col("raw_rows").isNull()).alias("extra"))
    bad = (F.col("null_keys") > 0) | (F.col("duplicate_groups") > 0) | (F.col("missing") > 0) | ((F.col("extra") > 0) if check_extra else F.lit(False))
    return n.withColumn("verdict", F.when(bad, "REVIEW_REQUIRED").otherwise("RECONCILED"))


def business_key_ok(df: DataFrame, keys: list[str]) -> DataFrame:
    blank = reduce(Column.__or__, [F.col(k).isNull() | (F.btrim(F.col(k).cast("string")) == "") for k in keys])
    g = df.groupBy(*keys).agg(F.count("*").alias("c"), F.bool_or(blank).alias("b"))
    return g.agg((~F.coalesce(F.bool_or("b"), F.lit(False))).alias("no_blank_parts"), (F.count_if(F.col("c") > 1) == 0).alias("no_duplicates"))


def encoding_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: values with a question mark, values with Cyrillic letters and their share."""
    parts = [F.struct(F.lit(c).alias("column"), F.count(c).alias("filled"), F.count_if(F.contains(F.col(c), F.lit("?"))).alias("with_question_mark"), F.count_if(F.col(c).rlike("[\\u0400-\\u04FF]")).alias("cyrillic")) for c in cols]
    return df.agg(F.array(*parts).alias("r")).select(F.inline("r"))


# --- catalogue ------------------------------------------------------------------------------------------------------


def catalog(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, column_name, position, data_type of the frames' schemas."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(t, f.name, i + 1, f.dataType.simpleString()) for t, df in tables.items() for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "table_name string, column_name string, position int, data_type string")


def shared_columns(cat: DataFrame) -> DataFrame:
    a, b = cat.alias("a"), cat.alias("b")
    return a.join(b, (F.col("a.column_name") == F.col("b.column_name")) & (F.col("a.table_name") < F.col("b.table_name"))).select(F.col("a.table_name").alias("table_a"), F.col("b.table_name").alias("table_b"), F.col("a.column_name").alias("column_name"))


def key_like_columns(cat: DataFrame) -> DataFrame:
    return cat.where(F.lower("column_name").rlike("(id|key)$")).select("table_name", "column_name")


def required_columns(cat: DataFrame, required: DataFrame) -> DataFrame:
    return required.join(cat, ["table_name", "column_name"], "left").select("table_name", "column_name", F.col("position").isNotNull().alias("present"), "data_type")


def preflight(source: DataFrame, key: str, mapped: list[str]) -> DataFrame:
    """check, status for the key and every mapped column (each once), and the verdict; reads schemas alone."""
    spark, have = source.sparkSession, {c.lower() for c in source.columns}
    rows = [(f"{kind} {c}", "OK" if c.lower() in have else "BLOCKED") for kind, names in (("key", [key]), ("column", list(dict.fromkeys(mapped)))) for c in names]
    verdict = "BLOCKED" if any(s == "BLOCKED" for _, s in rows) else "READY"
    return spark.createDataFrame([*rows, ("verdict", verdict)], "check string, status string")


def detect_drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Two column lists compared: added, removed and changed columns and the drift type.

    A type change outranks a removal, a removal an addition; no old columns: new_table; no drift: null.
    """
    j = old.select("column_name", F.col("data_type").alias("old_type")).join(new.select("column_name", F.col("data_type").alias("new_type")), "column_name", "full_outer")
    pick = lambda cond: F.array_join(F.array_sort(F.collect_list(F.when(cond, F.col("column_name")))), ",")
    n = j.agg(F.count("old_type").alias("n_old"), pick(F.col("old_type").isNull()).alias("added"), pick(F.col("new_type").isNull()).alias("removed"), pick(F.col("old_type") != F.col("new_type")).alias("type_changes"))
    return n.select(F.when(F.col("n_old") == 0, "new_table").when(F.col("type_changes") != "", "type_changed").when(F.col("removed") != "", "columns_removed").when(F.col("added") != "", "columns_added").alias("drift_type"), "added", "removed", "type_changes")


def closure(edges: DataFrame, roots: DataFrame, max_depth: int) -> DataFrame:
    """(root, node, depth): nodes reachable over edges (src, dst) with their least depth. Stops on cycles.

    One join per level; each level is checkpointed, so the plan does not grow with depth.
    """
    found = front = roots.select("root", F.col("root").alias("node"), F.lit(0).alias("depth"))
    for depth in range(1, max_depth + 1):
        step = front.join(edges, F.col("node") == F.col("src")).select("root", F.col("dst").alias("node")).distinct()
        front = step.join(found.select("root", "node"), ["root", "node"], "left_anti").withColumn("depth", F.lit(depth))
        front = saved(front)
        if front.isEmpty():
            break
        found = found.unionByName(front)
    return found
