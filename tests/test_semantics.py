"""Hand-made rows for what the generated tables do not hold."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import columns as c
from millrace.operators import anomaly, cleaning, features, items, loading, marts, merging, monitoring, quality
from millrace.streaming.upserts import stream_daily, stream_upsert


def one(spark, value, f, ddl="string"):
    return spark.createDataFrame([(value,)], f"x {ddl}").select(f(F.col("x")).alias("y")).first()["y"]


def test_text_to_types(spark):
    assert one(spark, "  a ", c.clean_text) == "a" and one(spark, "   ", c.clean_text) is None
    assert [one(spark, x, c.to_bigint) for x in (" 12 ", "1a", "", None, "9" * 20)] == [12, None, None, None, None]
    assert [one(spark, x, lambda v: c.to_number(v).cast("double")) for x in ("1e3", "NaN", "x", None)] == [1000.0, None, None, None]
    assert one(spark, "1900-01-01", lambda v: c.to_ts(v, ("1900-01-01",))) is None
    assert one(spark, "2024-02-03", c.to_ts) == dt.datetime(2024, 2, 3) and one(spark, "n/a", c.to_ts) is None
    assert one(spark, "03.02.2024", lambda v: c.to_ts(v, guard=True)) is None
    assert one(spark, "a\tb\nc\r\x00", c.plain_line) == "a b c"
    assert [one(spark, x, c.null_nonfinite, "double") for x in (float("nan"), float("-inf"), 1.5)] == [None, None, 1.5]


def test_days_round_down_before_zero(spark):
    got = one(spark, dt.datetime(2024, 1, 2, 1), lambda v: c.days_between(v, F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")), "timestamp_ntz")
    assert got == -1


def test_days_count_fractions_of_a_second(spark):
    noon = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    days = lambda t: one(spark, t, lambda v: c.days_between(v, noon), "timestamp_ntz")
    assert [days(dt.datetime(2024, 1, 2, 12, 0, 0, us)) for us in (0, 1, 500_000)] == [13, 12, 12]
    assert [days(dt.datetime(2024, 1, 15, 12, 0, 0, us)) for us in (0, 1)] == [0, -1] and days(None) is None


def test_python_gets_only_bytes_that_are_not_utf_8(spark):
    odd = [b"\xed\xa0\x80", b"\xc0\x80", b"a\x00\xf0\x9f\x98\x80", b"", b"\xff", "ü".encode() * 3, b"\xf4\x90\x80\x80", b"\xe2\x82", b"\xef\xbb\xbfa"]
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(odd)], "i int, x binary")
    got = cleaning.decode_bytes(df, "x", ["utf-8"])
    want = []
    for b in odd:
        try:
            want.append(b.decode())
        except UnicodeDecodeError:
            want.append(None)
    assert [r["x"] for r in got.orderBy("i").collect()] == want
    assert "try_validate_utf8" in got._jdf.queryExecution().toString()
    first = cleaning.decode_bytes(df, "x", ["utf-8", "latin-1"])
    assert [r["x"] for r in first.orderBy("i").collect()] == [b.decode("latin-1") if w is None else w for b, w in zip(odd, want)]


def test_bytes_and_rejects(spark):
    df = spark.createDataFrame([(bytearray("Привет".encode("cp1251")),), (bytearray("ü".encode()),), (None,)], "x binary")
    assert [r["x"] for r in cleaning.decode_bytes(df, "x", ["utf-8", "cp1251", "cp1252"]).collect()] == ["Привет", "ü", None]
    assert cleaning.decode_bytes(df.limit(1), "x", ["utf-8"]).first()["x"] is None
    rows = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    good, bad = cleaning.split_rejects(rows, {"no key": F.col("k").isNull()})
    assert good.count() == 1 and bad.first().asDict() == {"row_json": '{"v":"b"}', "reason": "no key"}


def test_row_ids_are_gapless_and_ordered(spark):
    rows = spark.createDataFrame([(i * 7 % 100, str(i)) for i in range(100)], "a int, b string").repartition(7)
    got = cleaning.with_row_id(rows, ["a"]).orderBy("row_id").collect()
    assert [r["row_id"] for r in got] == list(range(1, 101)) and [r["a"] for r in got] == sorted(r["a"] for r in got)


def test_null_keys_and_duplicates_in_merges(spark):
    t = spark.createDataFrame([(1, "a"), (2, None), (None, "n")], "k int, v string")
    b = spark.createDataFrame([(1, "a"), (2, None), (2, None), (3, "x"), (3, "y"), (None, "m"), (None, "m")], "k int, v string")
    out = merging.upsert(t, b, ["k"])
    assert merging.changes(out).first().asDict() == {"inserted": 3, "updated": 0, "unchanged": 2, "conflicted": 0}
    assert sorted((r["k"] or 0, r["v"] or "") for r in out.collect()) == [(0, "m"), (0, "m"), (0, "n"), (1, "a"), (2, ""), (3, "y")]
    nothing = merging.upsert(t, b, ["k"], action="nothing")
    assert merging.changes(nothing).first()["conflicted"] == 2


_rows = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 3)), max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(_rows, _rows)
def test_merges_are_idempotent(spark, old, new):
    ddl = "k int, v int"
    t = spark.createDataFrame(list(dict(old).items()), ddl)
    b = spark.createDataFrame(new, ddl)
    first = merging.upsert(t, b, ["k"])
    again = merging.changes(merging.upsert(first.drop("_change"), b, ["k"])).first()
    assert again["inserted"] == again["updated"] == 0
    assert merging.key_diff(b, first, ["k"]).where("side = 'missing'").count() == 0


def test_merge_order_counts(spark):
    a, b = (spark.createDataFrame(r, "k int, v string") for r in ([(1, "a")], [(1, "b"), (2, "b")]))
    assert {tuple(r) for r in merging.merge_wins([a, b], ["k"]).collect()} == {(1, "b"), (2, "b")}
    assert {tuple(r) for r in merging.merge_wins([a, b], ["k"], last=False).collect()} == {(1, "a"), (2, "b")}


def test_features_leave_null_keys_out(spark):
    daily = spark.createDataFrame([(dt.date(2024, 1, 1), None, None, 5, 1.0, 1.0), (dt.date(2024, 1, 1), "e", "E", 0, 0.0, 2.0), (dt.date(2024, 1, 2), "e", "E", 10, 5.0, 4.0)], "operation_date date, employee_id string, employee_name string, total_operations long, total_duration double, avg_duration double")
    r = features.employee_features(daily, "2024-01-12").collect()
    assert len(r) == 1 and r[0]["avg_duration"] == 3.0 and r[0]["scan_interval"] == 5760.0 and r[0]["time_since_last_scan"] == 10
    assert features.rule_labels(features.employee_features(daily, "2024-01-12"), "employee").first()["is_anomaly"] == 1
    assert features.daily_series(daily).where("operations_ma7 is not null").count() == 0


def test_quality_edges(spark):
    empty = spark.createDataFrame([], "k string")
    rows = {r["name"]: r for r in quality.quality_checks(empty, "k", ["k"], 1).collect()}
    assert not rows["not_empty"]["passed"] and rows["null_rate_k"]["passed"] and rows["no_duplicates"]["passed"]
    half = spark.createDataFrame([("a",), (None,)], "k string")
    assert {r["name"]: r["passed"] for r in quality.quality_checks(half, "k", ["k"], 1, 50.0).collect()}["null_rate_k"]
    same = quality.reconcile(half.where("k is not null"), half.where("k is not null"), "k").first()
    assert same["verdict"] == "RECONCILED" and quality.reconcile(half, half, "k").first()["null_keys"] == 1
    drift = quality.detect_drift(spark.createDataFrame([], "column_name string, data_type string"), spark.createDataFrame([("a", "int")], "column_name string, data_type string")).first()
    assert drift["drift_type"] == "new_table"
    empty_profile = marts.profile_columns(spark.createDataFrame([(" ",), (None,)], "a string"), ["a"]).first()
    assert empty_profile["decision"] == "empty" and empty_profile["non_blank"] == 0
    m = marts.binary_metrics(spark.createDataFrame([(0, 0)], "y int, h int"), "y", "h").first()
    assert m["precision"] == m["recall"] == m["f1"] == 0.0


def test_closure_stops_on_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "src long, dst long")
    got = {(r["node"], r["depth"]) for r in quality.closure(edges, spark.createDataFrame([(1,)], "root long"), 9).collect()}
    assert got == {(1, 0), (2, 1), (3, 2), (4, 3)}
    links = {(r["node"], r["depth"], r["via"]) for r in items.traverse_links(edges, spark.createDataFrame([(1,)], "root long"), 2).collect()}
    assert links == {(1, 0, None), (2, 1, 1), (3, 2, 2)}


def test_range_states_and_rank(spark):
    chunks = spark.createDataFrame([(1, 1, 0, 10), (1, 2, 10, 20), (1, 3, 25, 30), (1, 4, 28, 40), (1, 5, 40, 40)], "run_id int, chunk_no int, range_start int, range_end int")
    assert [r["range_status"] for r in monitoring.range_continuity(chunks).orderBy("chunk_no").collect()] == ["OK", "OK", "GAP", "OVERLAP", "INVALID_RANGE"]
    v = spark.createDataFrame([(1, float(i)) for i in range(20)], "k int, x double")
    assert monitoring.nearest_rank(v, "x", 0.95, ["k"]).first()["value"] == 19.0


def test_offsets_keep_their_clock(spark):
    df = spark.createDataFrame([("2024-01-01T09:00:00.000+0300",), ("2024-01-01T17:50:00.000+03:00",), ("2024-01-01T17:50:01",), ("bad",)], "t string")
    assert [r[0] for r in df.select(items.in_time_window(F.col("t"), "09:00:00", "17:50:00")).collect()] == [True, True, False, False]
    ts = [r[0] for r in df.select(items.parse_ts(F.col("t"))).collect()]
    assert ts[0] is not None and ts[1] is not None and ts[3] is None


def test_nested_issues(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"key":"A-1","fields":{"summary":"s","assignee":{"name":"Bob","displayName":" "},"components":[{"name":"x"},{"name":"y"}],"comment":{"comments":[{"author":{"name":"Ann"},"body":"hi","created":"2024-01-01T00:00:00Z"}]}},"changelog":{"histories":[{"author":{"name":"Bob"},"created":"2024-01-02T00:00:00Z","items":[{"field":"Status","fromString":"a","toString":"b"},{"field":"other"}]}]}}\n{"key":"A-2"}\n')
    df = items.read_issues(spark, str(tmp_path))
    flat = {r["issue_key"]: r for r in items.flatten_issues(df).collect()}
    assert flat["A-1"]["components"] == "x, y" and flat["A-1"]["assignee"] == "Bob" and flat["A-2"]["summary"] is None
    assert {(r["event_type"], r["author"]) for r in items.change_events(df).collect()} == {("comment_added", "Ann"), ("status_changed", "Bob")}
    assert df.where("key = 'A-1'").select(items.identities("fields.assignee")).first()[0] == ["bob"]
    kinds = spark.createDataFrame([("a.PNG", ""), ("b", "application/pdf"), ("c.xlsx", ""), ("d", "")], "n string, m string")
    assert [r[0] for r in kinds.select(items.attachment_class(F.col("n"), F.col("m"))).collect()] == ["image", "pdf", "table", "other"]
    words = spark.createDataFrame([(1, 0, "b"), (1, 1, "A"), (1, 2, "a"), (1, 3, "c")], "k int, p int, w string")
    assert items.ordered_distinct(words, "k", "p", "w").first()["values"] == "b, A, c"


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", "ä b"), ("2", None)], "Id string, Text string")
    loading.write_tsv(df, str(tmp_path / "t"))
    assert {tuple(r) for r in loading.read_tsv(spark, str(tmp_path / "t")).collect()} == {("1", "ä b"), ("2", None)}
    (tmp_path / "r.md").write_text("# T\n| Mode | Description | Category | Keywords |\n|---|---|---|---|\n| m1 | d | c | k1, k2 |\ntext\n")
    row = loading.read_registry(spark, str(tmp_path / "r.md")).collect()
    assert len(row) == 1 and row[0]["keywords"] == ["k1", "k2"]
    path = str(tmp_path / "v")
    loading.load(spark, df, path, "full", ["Id"])
    loading.load(spark, spark.createDataFrame([("2", "x"), ("3", "y")], "Id string, Text string"), path, "resume", ["Id"])
    assert spark.read.parquet(path).count() == 3
    new = loading.load(spark, spark.createDataFrame([("2", "x")], "Id string, Text string"), path, "incremental", ["Id"])
    assert {tuple(r) for r in spark.read.parquet(new).collect()} == {("1", "ä b"), ("2", "x"), ("3", "y")}
    preds = loading.range_predicates(loading.key_ranges(spark.range(1, 101), "id", 4), "id")
    assert len(preds) == 4 and sum(spark.range(1, 101).where(p).count() for p in preds) == 100


def test_stream_upsert_is_a_batch_upsert(spark, tmp_path):
    src, ddl = str(tmp_path / "in"), "k long, v string"
    for part in ([(1, "a"), (2, "b")], [(2, "c"), (3, "d")]):
        spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(src)
        n = stream_upsert(spark, src, ddl, str(tmp_path / "out"), ["k"], str(tmp_path / "cp"))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / f"out/v={n}")).collect()} == {(1, "a"), (2, "c"), (3, "d")}


def test_stream_daily(spark, tmp_path):
    src, ddl = str(tmp_path / "ev"), "employee_id string, start_time timestamp, duration_seconds double"
    spark.createDataFrame([("e", dt.datetime(2024, 1, 1, 5), 1.0), ("e", dt.datetime(2024, 1, 1, 6), 2.0), ("e", dt.datetime(2024, 1, 5), 1.0)], ddl).write.parquet(src)
    q = stream_daily(spark, src, ddl).writeStream.format("memory").queryName("daily_out").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [(r["employee_id"], r["operations"], r["duration"]) for r in spark.sql("select * from daily_out").collect()] == [("e", 2, 3.0)]


def test_forest_flags_a_tenth_and_ranks_outliers_first(spark):
    import numpy as np

    r = np.random.default_rng(0)
    rows = [(str(i), float(a), float(b)) for i, (a, b) in enumerate(r.normal(size=(400, 2)))] + [("out", 30.0, -30.0), ("nan", float("nan"), None)]
    df = spark.createDataFrame(rows, "id string, a double, b double")
    m = anomaly.feature_matrix(df, "id", ["a", "b"])
    s1 = anomaly.score_forest(m, anomaly.fit_forest(m, ["a", "b"], trees=40), "x").collect()
    assert min(s1, key=lambda x: x["anomaly_score"])["entity_id"] == "out"
    assert 0.07 <= sum(x["is_anomaly_predicted"] for x in s1) / len(s1) <= 0.13
    m2 = m.repartition(7)
    s2 = anomaly.score_forest(m2, anomaly.fit_forest(m2, ["a", "b"], trees=40), "x").collect()
    assert {x["entity_id"]: x["anomaly_score"] for x in s1} == {x["entity_id"]: x["anomaly_score"] for x in s2}
