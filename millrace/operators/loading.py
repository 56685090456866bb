"""Reading, writing and incremental loads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.merging import upsert


def scan(spark: SparkSession, path: str, columns: list[str] | None = None, where: str | None = None, limit: int | None = None) -> DataFrame:
    """A Parquet scan with columns by name in any case and a filter that reaches the files."""
    df = spark.read.parquet(path)
    if where:
        df = df.where(where)
    if columns:
        found = {c.lower(): c for c in df.columns}
        df = df.select(*[F.col(found[c.lower()]).alias(c) for c in columns])
    return df.limit(limit) if limit else df


def key_ranges(df: DataFrame, key: str, parts: int) -> DataFrame:
    """(range_no, lo, hi]: equal ranges that cover all keys, with lo one below the least."""
    ends = df.agg(F.min(key).alias("a"), F.max(key).alias("b")).where("a is not null")
    width = F.greatest(F.lit(1), F.ceil((F.col("b") - F.col("a") + 1) / parts))
    r = ends.select("a", "b", width.alias("w"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("range_no"))
    lo = F.col("a") - 1 + F.col("range_no") * F.col("w")
    return r.select("range_no", lo.alias("lo"), F.least(lo + F.col("w"), F.col("b")).alias("hi")).where("lo < hi")


def range_predicates(ranges: DataFrame, key: str) -> list[str]:
    """Predicates for a partitioned JDBC read, one per range; the list is as long as `parts`."""
    return [f"{key} > {r['lo']} AND {key} <= {r['hi']}" for r in ranges.orderBy("range_no").collect()]


def time_ranges(df: DataFrame, ts: str, step: str) -> DataFrame:
    """[lo, hi) ranges of `step` from the start of the first day on, empty ones included."""
    ends = df.agg(F.date_trunc("day", F.min(ts)).alias("a"), F.max(ts).alias("b")).where("a is not null")
    return ends.select(F.explode(F.expr(f"sequence(a, b, interval {step})")).alias("lo")).withColumn("hi", F.col("lo") + F.expr(f"interval {step}"))


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """UTF-8 tab-separated text with a header; all columns text, names in lower case, empty is null."""
    df = spark.read.csv(path, sep="\t", header=True, nullValue="", encoding="UTF-8")
    return df.toDF(*[c.lower() for c in df.columns])


def write_tsv(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Text with a header; times keep their microseconds."""
    times = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    df.write.mode("overwrite").options(**times).csv(path, sep=sep, header=True, encoding="UTF-8", emptyValue="")


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a markdown table of four columns: mode, description, category, keywords (split by commas)."""
    lines = spark.read.text(path).where(F.trim("value").startswith("|") & ~F.trim("value").rlike(r"^\|[\s:|-]+\|?$"))
    cells = F.transform(F.split(F.regexp_replace(F.trim("value"), r"^\||\|$", ""), r"\|"), lambda x: F.trim(x))
    rows = lines.select(cells.alias("c")).where((F.size("c") >= 4) & (F.lower(F.col("c")[0]) != "mode"))
    return rows.select(F.col("c")[0].alias("mode"), F.col("c")[1].alias("description"), F.col("c")[2].alias("category"), F.filter(F.transform(F.split(F.col("c")[3], ","), lambda x: F.trim(x)), lambda x: x != "").alias("keywords"))


MEMBER_COLUMNS = ("account_id", "name", "key", "display_name", "email")
# Texts that mean an active member.
TRUE_TEXTS = ("1", "true", "yes", "y", "on", "да")


def members(rows: DataFrame, exclude_inactive: bool = True, exclude: tuple[str, ...] = ()) -> DataFrame:
    """The five identity columns, trimmed (null: empty), and `active` of a member list; a missing column is a ValueError.

    Without a column `active` all are active; with one, null and other texts than TRUE_TEXTS are not. Members stay if they
    have an identity and none of their identities contains one of the excluded texts, both in lower case. Repeats stay.
    """
    missing = [c for c in MEMBER_COLUMNS if c not in rows.columns]
    if missing:
        raise ValueError(f"the member list has no columns {', '.join(missing)}")
    cell = lambda c: F.coalesce(F.btrim(F.col(c).cast("string")), F.lit(""))
    active = F.lower(cell("active")).isin(*TRUE_TEXTS) if "active" in rows.columns else F.lit(True)
    found = rows.select(*[cell(c).alias(c) for c in MEMBER_COLUMNS], active.alias("active"))
    if exclude_inactive:
        found = found.where("active")
    for text in filter(None, (x.strip().lower() for x in exclude)):
        found = found.where(~reduce(Column.__or__, [F.contains(F.lower(c), F.lit(text)) for c in MEMBER_COLUMNS]))
    return found.where(reduce(Column.__or__, [F.col(c) != "" for c in MEMBER_COLUMNS]))


def load(spark: SparkSession, batch: DataFrame, path: str, mode: str, keys: list[str]) -> str:
    """full and reload overwrite; resume appends rows with new keys; incremental upserts. Returns the path written.

    A merge reads the old version while it writes the new one, so it goes to a path of its own next to it.
    """
    if mode in ("full", "reload"):
        batch.write.mode("overwrite").parquet(path)
        return path
    old = spark.read.parquet(path)
    if mode == "resume":
        batch.join(old.select(*keys), keys, "left_anti").write.mode("append").parquet(path)
        return path
    if mode != "incremental":
        raise ValueError(f"unknown load mode {mode}")
    new = f"{path.rstrip('/')}-next"
    upsert(old, batch, keys).drop("_change").write.mode("overwrite").parquet(new)
    return new


def write_report(sheets: dict[str, DataFrame], path: str) -> None:
    """One folder per result set."""
    for name, df in sheets.items():
        df.write.mode("overwrite").csv(f"{path}/{name}", header=True)


def pending_tables(state: DataFrame, as_of: str, hours: float = 24) -> DataFrame:
    """Tables never loaded or loaded longer ago than that, never-loaded ones first by last_loaded."""
    age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.col("last_loaded").cast("timestamp"))) / 3.6e9
    return state.where(F.col("last_loaded").isNull() | (age > hours))


def union_by_name(dfs: list[DataFrame]) -> DataFrame:
    """Union with columns added as the schemas grow."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def schema_of(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)
