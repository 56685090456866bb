"""Audit log, exported chunks and member lists on small hand-made tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.operators import audit, loading
from millrace.operators import monitoring as m

MEMBER = "account_id string, name string, key string, display_name string, email string"


def test_members_need_their_columns_and_an_identity(spark):
    rows = [(" a1 ", None, "", "Ann", "a@x"), (None, " ", None, "", None), ("b", "Bot-7", None, None, None), ("c", None, None, None, None)]
    df = spark.createDataFrame(rows, MEMBER)
    assert sorted(r["account_id"] for r in loading.members(df).collect()) == ["a1", "b", "c"]
    assert [tuple(r) for r in loading.members(df.where("display_name = 'Ann'")).collect()] == [("a1", "", "", "Ann", "a@x", True)]
    assert sorted(r["account_id"] for r in loading.members(df, exclude=(" BOT", " ", "@X")).collect()) == ["c"]
    with pytest.raises(ValueError, match="key, email"):
        loading.members(df.drop("email", "key"))
    assert loading.members(df.limit(0)).count() == 0


@pytest.mark.parametrize("text, active", [("1", True), (" Yes ", True), ("ДА", True), ("ON", True), ("0", False), ("", False), (None, False), ("maybe", False)])
def test_texts_of_active(spark, text, active):
    df = spark.createDataFrame([("a", "n", "k", "d", "e", text)], MEMBER + ", active string")
    assert [r["active"] for r in loading.members(df, exclude_inactive=False).collect()] == [active]
    assert loading.members(df).count() == int(active)


def test_audit_entries(spark, tmp_path):
    rows = spark.createDataFrame([(1, "t", "2024-01-01 00:00:00", "x" * 600, None), (2, None, None, None, 5), (3, "t", "2024-01-02 00:00:00", "é\"", 7)], "run int, tbl string, at string, msg string, n int")
    log = audit.entries(rows, "ERROR", F.col("tbl"), F.col("run"), F.col("at"), {"msg": F.col("msg"), "n": F.col("n")})
    for _ in range(2):
        audit.append(log, f"{tmp_path}/log")
    audit.append(audit.entries(rows, "LOAD_START", F.col("tbl"), F.col("run"), F.col("at")), f"{tmp_path}/log")
    kept = spark.read.parquet(f"{tmp_path}/log")
    assert [(r["run_id"], r["action"], r["details"]) for r in audit.recent(kept, "t", 4).collect()] == [
        (3, "ERROR", '{"msg":"é\\"","n":7}'), (3, "ERROR", '{"msg":"é\\"","n":7}'), (3, "LOAD_START", None), (1, "ERROR", '{"msg":"' + "x" * 500 + '"}'),
    ]
    everything = audit.recent(kept).collect()
    assert len(everything) == 9 and [r["run_id"] for r in everything[-3:]] == [2, 2, 2]


def test_completed_chunks(spark):
    cols = "run_id int, chunk_no int, status string, attempt_count int, rows_read int, rows_inserted int, rows_conflicted int, started_at timestamp_ntz, completed_at timestamp_ntz"
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    rows = spark.createDataFrame([(1, n, s, 0, 5, 5, 0, None, None) for n, s in ((1, "completed"), (2, "completed"), (3, "failed"), (4, "completed"))], cols)
    end = F.when(F.col("chunk_no") == 1, at + F.expr("interval 2 seconds")).when(F.col("chunk_no") == 2, at)
    got = m.completed_chunks(rows.withColumns({"started_at": at, "completed_at": end})).collect()
    assert sorted((r["chunk_no"], r["duration_seconds"], r["rows_per_second"]) for r in got) == [(1, 2.0, 3), (2, None, None), (4, None, None)]
