"""Materialised summaries that are refreshed from change sets, a version at a time.

The state is cut into buckets by group key. A refresh reads the change set and the state of the buckets it touches, never
the base table, and writes new files for these buckets alone; a manifest names the version of every bucket, and renaming
it into place is what makes a version the current one. A batch that was committed before changes nothing.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import ROWS

BUCKETS = 16  # at least; a task writes a bucket, so a view gets one for every ROWS rows of its first change set


@dataclass(frozen=True)
class Summary:
    """What a view holds per group: rows, sums, numbers of distinct values, and least and greatest values, of columns.

    Nulls count as rows only. A sum without any value is null.
    """

    keys: tuple[str, ...]
    sums: tuple[str, ...] = ()
    distincts: tuple[str, ...] = ()
    extremes: tuple[str, ...] = ()

    @property
    def valued(self) -> tuple[str, ...]:
        """Columns of which the state counts every value of a group."""
        return tuple(dict.fromkeys((*self.distincts, *self.extremes)))


def changes(before: DataFrame | None, after: DataFrame | None) -> DataFrame:
    """A change set: rows as they were (-1) and as they are now (+1). An update is in both, an insert in `after` alone."""
    signed = [df.withColumn("_sign", F.lit(s)) for df, s in ((before, -1), (after, 1)) if df is not None]
    return signed[0] if len(signed) == 1 else signed[0].unionByName(signed[1])


def changed_rows(merged: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """The change set of an upsert that kept old values as old_<col>: rows with _change inserted, updated or deleted."""
    was = merged.where(F.col("_change").isin("updated", "deleted")).select(key, *[F.col(f"old_{c}").alias(c) for c in cols])
    return changes(was, merged.where(F.col("_change").isin("updated", "inserted")).select(key, *cols))


class MaterializedView:
    """A summary kept in a folder that driver and executors share.

    Counts may not become negative: a change set that takes back more rows of a group than there are ends with an error
    before anything is committed. Without a number of buckets, the size of the first change set decides it.
    """

    def __init__(self, spark: SparkSession, path: str, summary: Summary, buckets: int | None = None):
        self.spark, self.path, self.summary, self.buckets = spark, path.rstrip("/"), summary, buckets
        self.folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self.files = self.folder.getFileSystem(spark._jsc.hadoopConfiguration())

    # --- manifests ---

    def _at(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _manifest(self) -> dict:
        """The current version: its number, batches and the version of every bucket."""
        names = [s.getPath().getName() for s in self.files.listStatus(self._at("manifests"))] if self.files.exists(self._at("manifests")) else []
        current = max((n for n in names if n.startswith("v-")), default=None)
        if current is None:
            return {"version": 0, "batches": [], "buckets": {}, "n": self.buckets}
        stream = self.files.open(self._at("manifests", current))
        try:
            return {"n": self.buckets or BUCKETS, **json.loads(bytes(stream.readAllBytes()).decode())}  # older manifests lack it
        finally:
            stream.close()

    def _commit(self, manifest: dict) -> None:
        """Rename the new manifest into place; if another writer was first, nothing of this refresh counts."""
        draft, target = self._at("manifests", f"draft-{uuid.uuid4().hex}"), self._at("manifests", f"v-{manifest['version']:09d}")
        stream = self.files.create(draft, False)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        if self.files.exists(target) or not self.files.rename(draft, target):
            self.files.delete(draft, False)
            raise RuntimeError(f"version {manifest['version']} was committed by another writer")

    @property
    def version(self) -> int:
        return self._manifest()["version"]

    # --- state ---

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.summary.keys), F.lit(self.buckets)).cast("int")

    def _state(self, manifest: dict, part: str, buckets: list[int] | None, schema) -> DataFrame:
        """Rows of a part of the state (groups, or the values of a column) in these buckets, or in all."""
        own = [b for b in manifest["buckets"] if buckets is None or int(b) in set(buckets)]
        paths = [f"{self.path}/data/v={manifest['buckets'][b]}/part={part}/bucket={b}" for b in own]
        there = [p for p in paths if self.files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p))]
        return self.spark.read.schema(schema).parquet(*there) if there else self.spark.createDataFrame([], schema)

    def _written(self, df: DataFrame, version: str, part: str) -> None:
        df.withColumn("bucket", self._bucket()).repartition("bucket").write.partitionBy("bucket").mode("overwrite").parquet(f"{self.path}/data/v={version}/part={part}")

    def _schemas(self, rows: DataFrame) -> tuple[str, dict[str, str]]:
        kind = lambda c: rows.schema[c].dataType.simpleString()
        keys = ", ".join(f"`{k}` {kind(k)}" for k in self.summary.keys)
        total = {c: rows.select(F.sum(c)).schema[0].dataType.simpleString() for c in self.summary.sums}
        columns = [f"{c}_sum {total[c]}, {c}_n long" for c in self.summary.sums] + [f"{c}_distinct long" for c in self.summary.distincts] + [f"{c}_min {kind(c)}, {c}_max {kind(c)}" for c in self.summary.extremes]
        return ", ".join([keys, "row_count long", *columns]), {c: f"{keys}, value {kind(c)}, n long" for c in self.summary.valued}

    # --- refresh and reading ---

    def refresh(self, batch: str, signed: DataFrame) -> bool:
        """Apply a change set (see changes()) as the next version; False if the batch is committed already.

        Sums and counts take the signed deltas; distinct values and extremes follow from the counts of each value, and
        only groups that the batch touches are computed anew.
        """
        manifest, s = self._manifest(), self.summary
        if batch in manifest["batches"]:
            return False
        if manifest["n"] is None:
            manifest["n"] = max(BUCKETS, -(-signed.count() // ROWS))
        self.buckets = manifest["n"]  # for good: a group stays in its bucket
        version, keys = f"{manifest['version'] + 1:09d}-{uuid.uuid4().hex[:8]}", list(s.keys)
        groups_schema, value_schemas = self._schemas(signed)
        delta_cols = [F.sum("_sign").cast("long").alias("row_count")] + [x for c in s.sums for x in (F.sum(F.col("_sign") * F.col(c)).alias(f"{c}_sum"), F.sum(F.when(F.col(c).isNotNull(), F.col("_sign"))).cast("long").alias(f"{c}_n"))]
        delta_path = f"{self.path}/data/v={version}/delta"
        signed.groupBy(*keys).agg(*delta_cols).write.parquet(delta_path)
        delta = self.spark.read.parquet(delta_path)
        touched = sorted(r[0] for r in delta.select(self._bucket()).distinct().collect())  # numbers below `buckets`
        parts = [self._state(manifest, "groups", touched, groups_schema).withColumn("_touched", F.lit(0)), delta.withColumn("_touched", F.lit(1))]
        for c in s.valued:
            old = self._state(manifest, f"values-{c}", touched, value_schemas[c])
            new = signed.where(F.col(c).isNotNull()).groupBy(*keys, F.col(c).alias("value")).agg(F.sum("_sign").cast("long").alias("n"))
            marked = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
            self._written(marked.groupBy(*keys, "value").agg(F.sum("n").alias("n")).where("n <> 0"), version, f"values-{c}")
            counted = self._state({"buckets": {str(b): version for b in touched}}, f"values-{c}", None, value_schemas[c])
            facts = [F.count(F.lit(1)).alias(f"{c}_distinct")] * (c in s.distincts) + ([F.min("value").alias(f"{c}_min"), F.max("value").alias(f"{c}_max")] if c in s.extremes else [])
            parts.append(counted.groupBy(*keys).agg(*facts, F.min("n").alias("_least")).withColumn("_touched", F.lit(2)))
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p, allowMissingColumns=True)
        add = [F.sum(c).alias(c) for c in ["row_count"] + [f"{c}{x}" for c in s.sums for x in ("_sum", "_n")]]
        fresh = [f"{c}_distinct" for c in s.distincts] + [f"{c}{x}" for c in s.extremes for x in ("_min", "_max")]
        add += [F.max(F.when(F.col("_touched") == 2, F.col(c))).alias(c) for c in fresh]
        low = F.min("_least").alias("_least") if s.valued else F.lit(None).cast("long").alias("_least")
        merged = rows.groupBy(*keys).agg(*add, low)
        for c in s.distincts:
            merged = merged.withColumn(f"{c}_distinct", F.coalesce(f"{c}_distinct", F.lit(0)))
        for c in s.sums:
            merged = merged.withColumn(f"{c}_sum", F.when(F.col(f"{c}_n") > 0, F.col(f"{c}_sum")))
        self._written(merged.where("row_count <> 0 or _least < 0"), version, "groups")
        wrong = self._state({"buckets": {str(b): version for b in touched}}, "groups", None, groups_schema + ", _least long").where("row_count < 0 or _least < 0").limit(1).count()
        if wrong:
            raise ValueError(f"batch {batch} takes back rows that are not there")
        self._commit({"n": manifest["n"], "version": manifest["version"] + 1, "batches": [*manifest["batches"], batch], "buckets": {**manifest["buckets"], **{str(b): version for b in touched}}})
        return True

    def read(self, like: DataFrame, version: int | None = None) -> DataFrame:
        """The groups of the current version; like: a frame with the base table's columns and types."""
        return self._state(self._manifest(), "groups", None, self._schemas(like)[0])
