"""Staged chunks and schema versions on small hand-made tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.operators import schema_history as sh
from millrace.operators import staging as st

SCHEMA = "k int, v string"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def moved(spark, path):
    return sorted(((r[st.CHUNK], r["k"], r["v"]) for r in st.chunks_of(spark, path, SCHEMA).collect()), key=str)


def test_chunk_staged_and_moved_twice_gives_its_rows_once(spark, tmp_path):
    s, t = f"{tmp_path}/s", f"{tmp_path}/t"
    schema = frame(spark).schema
    for _ in range(2):
        st.stage(frame(spark, (1, "b"), (1, "a"), (2, "a"), (None, "x"), (None, "x")), s, 1)
    st.stage(frame(spark, (2, "z"), (3, None)), s, 2)
    first = [st.finalize_chunk(spark, s, t, schema, ["k"], c) for c in (1, 2)]
    assert first == [(1, 5, 4, 1), (2, 2, 1, 1)]
    rows = moved(spark, t)
    assert rows == sorted([(1, 1, "a"), (1, 2, "a"), (1, None, "x"), (1, None, "x"), (2, 3, None)], key=str)
    assert [st.finalize_chunk(spark, s, t, schema, ["k"], c) for c in (2, 1)] == first[::-1]
    assert moved(spark, t) == rows


def test_restaged_and_empty_chunks(spark, tmp_path):
    s, t = f"{tmp_path}/s", f"{tmp_path}/t"
    schema = frame(spark).schema
    st.stage(frame(spark, (1, "a")), s, 1)
    st.stage(frame(spark, (5, "a")), s, 2)
    for c in (1, 2):
        st.finalize_chunk(spark, s, t, schema, ["k"], c)
    st.stage(frame(spark, (1, "again")), s, 2)  # now all conflict: nothing of the first attempt stays
    assert st.finalize_chunk(spark, s, t, schema, ["k"], 2) == (2, 1, 0, 1)
    assert moved(spark, t) == [(1, 1, "a")]
    st.stage(frame(spark), s, 1)
    assert st.finalize_chunk(spark, s, t, schema, ["k"], 1) == (1, 0, 0, 0)
    assert st.finalize_chunk(spark, s, t, schema, ["k"], 9) == (9, 0, 0, 0)  # never staged
    assert moved(spark, t) == []
    assert st.finalize_chunk(spark, s, t, schema, ["k"], 2) == (2, 1, 1, 0)  # the key is free again
    counts = st.chunk_counts(st.chunks_of(spark, s, SCHEMA), st.chunks_of(spark, t, SCHEMA)).collect()
    assert [tuple(r) for r in counts] == [(2, 1, 1, 0)]


def test_staging_by_column_replaces_only_named_chunks(spark, tmp_path):
    s = f"{tmp_path}/s"
    st.stage(frame(spark, (1, "a"), (2, "a")), s, F.col("k"))
    st.stage(frame(spark, (2, "b")), s, F.col("k"))
    assert moved(spark, s) == [(1, 1, "a"), (2, 2, "b")]
    with pytest.raises(Exception, match="without a chunk"):
        st.stage(frame(spark, (None, "a")), s, F.col("k"))


def test_only_keys_of_the_chunks_range_are_read_from_the_target(spark, tmp_path, capsys):
    t = f"{tmp_path}/t"
    st.stage(frame(spark, (1, "a")), t, 1)
    st.chunks_of(spark, t, SCHEMA).where((F.col(st.CHUNK) != 2) & F.col("k").between(F.lit(3), F.lit(4))).select("k").explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(k,3)" in plan and "PartitionFilters" in plan and "ReadSchema: struct<k:int>" in plan


@pytest.mark.parametrize("values, kind", [
    (["1", " -2 ", None, ""], "bigint"), (["1", "2.50", ".5", "3."], "decimal"), (["1", "1e3"], "text"), (["9" * 19], "decimal"), (["9" * 21], "text"),
    (["2024-02-29", "2024-01-01 10:00:00.5", None], "timestamp"), (["2023-02-29"], "text"), (["2024-01-01", "5"], "text"), ([None, "  "], "void"), ([], "void"), (["NaN"], "text"), (["٣"], "text"),
])
def test_type_of_a_column_is_the_least_that_takes_all_values(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], "`a.b` string").repartition(3)
    r = sh.inferred_types(df, "t").collect()
    assert [(x["column_name"], x["data_type"], x["filled"]) for x in r] == [("a.b", kind, sum(bool(v and v.strip()) for v in values))]


def test_versions_only_when_the_fingerprint_changes(spark, tmp_path):
    path = f"{tmp_path}/h"
    one = spark.createDataFrame([("1", "x")], "a string, b string")
    wide = spark.createDataFrame([("1.5", "x", "2024-01-01")], "a string, b string, c string")
    for df in (one, one, wide, one, one.select("b", "a")):
        sh.append_version(spark, path, sh.inferred_types(df, "t"))
    sh.append_version(spark, path, sh.inferred_types(one.limit(0), "empty"))
    got = sh.schema_history(sh.read_history(spark, path)).orderBy("table_name", "version").drop("fingerprint").collect()
    assert [tuple(r) for r in got] == [
        ("empty", 1, "a:void,b:void", "new_table", "", "", ""),
        ("t", 1, "a:bigint,b:text", "new_table", "", "", ""),
        ("t", 2, "a:decimal,b:text,c:timestamp", "type_changed", "c", "", "a"),
        ("t", 3, "a:bigint,b:text", "type_changed", "", "c", "a"),
        ("t", 4, "b:text,a:bigint", None, "", "", ""),
    ]
