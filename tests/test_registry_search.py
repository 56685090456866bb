"""Search by registry entry: several passes, odd rows, and fragments against plain Python."""

import pandas as pd
from millrace.operators import registry_search as r
from pyspark.sql import functions as F

ENTRIES = [(1, ["Alpha", "beta gamma"]), (2, ["gamma"]), (3, []), (4, ["", "alp"]), (5, ["zeta\nalpha"])]


def tables(spark):
    issues = [(1, "Alpha first", "then beta gamma", True), (2, None, "x" * 100 + " GAMMA " + "y" * 100, False), (3, "", None, False), (4, "ends in zeta", "alpha begins", False), (5, "nothing", "here", True)]
    issues = spark.createDataFrame(issues, "issue_key long, summary string, description string, has_attachment boolean").withColumns({"labels": F.array(F.lit("A"), F.lit(None)), "project": F.lit("p"), "at": F.lit("x"), "kind": F.lit("x")})
    registry = spark.createDataFrame([(e, "m", "c", k) for e, k in ENTRIES], "entry long, mode string, category string, keywords array<string>")
    comments = spark.createDataFrame([(1, 0, "gamma here"), (1, 1, None), (5, 0, "gamma")], "issue_key long, pos long, text string")
    files = spark.createDataFrame([(1, 0, "alpha.bin", ""), (1, 1, "shot.png", None), (1, 2, "none.zip", "")], "issue_key long, pos long, name string, mime string")
    links = spark.createDataFrame([(1, 2), (1, 2), (1, 1), (2, 4)], "issue_key long, other long")
    subtasks = spark.createDataFrame([(2, 4), (2, 1), (1, 4)], "issue_key long, other long")
    return issues, registry, comments, files, links, subtasks


def rows_of(df):
    return sorted(((x["issue_key"], x["entry"], x["place"], x["via"], x["pos"], x["matched"], x["status"], x["confidence"], x["fragment"]) for x in df.collect()), key=str)


def test_places_and_passes(spark):
    whole = rows_of(r.find_matches(*tables(spark), labels=["a"]))
    assert whole == rows_of(r.find_matches(*tables(spark), labels=["a"], entries=1))
    assert rows_of(r.find_matches(*tables(spark), labels=["b"])) == []
    got = {x[:6] + x[7:8] for x in whole}
    assert (1, 1, "summary", None, 0, "Alpha", "high") in got
    assert (1, 1, "description", None, 0, "Alpha, beta gamma", "high") in got
    assert (1, 2, "comment", None, 0, "gamma", "medium") in got
    assert (1, 1, "attachment", None, 0, "Alpha", "medium") in got and (1, 2, "attachment", None, 1, None, "low") in got
    assert (1, 2, "linked_description", 2, 0, "gamma", "high") in got
    assert (4, 5, "description", None, 0, "zeta\nalpha", "high") in got  # across the line break
    assert (1, 1, "subtask", 4, 0, "Alpha", "medium") in got and not any(x[2] == "linked_subtask" and x[3] == 1 for x in got)
    assert not any(x[1] == 3 or x[0] in (3, 5) for x in got)
    text = "x" * 100 + " GAMMA " + "y" * 100
    assert [x[8] for x in whole if x[:3] == (2, 2, "description")] == ["..." + f"\n{text}"[42:167].replace("\n", " ").strip() + "..."]


def test_empty_tables(spark):
    issues, registry, *others = tables(spark)
    assert r.find_matches(issues.limit(0), registry, *[o.limit(0) for o in others]).count() == 0
    assert r.find_matches(issues, registry.limit(0), *others).count() == 0
    assert r.dedupe_matches(r.find_matches(issues, registry.limit(0), *others)).count() == 0


def test_dedupe_keeps_order_and_three_fragments(spark):
    got = {(x["issue_key"], x["mode"]): x for x in r.dedupe_matches(r.find_matches(*tables(spark))).collect()}[1, "m"]
    assert got["places"].startswith("summary; description") and got["confidence"] == "high" and got["fragments"].count(" | ") == 2


def test_hits_are_handed_on_in_small_pieces(monkeypatch):
    monkeypatch.setattr(r, "HITS", 10)
    sizes = []

    class Rows:
        class sparkSession:  # noqa: N801
            class sparkContext:  # noqa: N801
                @staticmethod
                def broadcast(value):
                    return type("Sent", (), {"value": value})

        def select(self, *cols):
            return self

        def mapInPandas(self, run, schema):
            sizes.extend(len(part) for part in run(iter([pd.DataFrame({"k": range(100), "text": ["x"] * 100})])))
            return self

    monkeypatch.setattr(r, "_passes", lambda registry, entries: iter([[(1, ["x"])]]))
    r._searched(Rows(), None, "k long, entry long", 5, lambda s, row: [(1,), (2,)], ["k"], ["text"])
    assert sum(sizes) == 200 and max(sizes) <= 11


def test_matches_are_found_once_for_all_lists(spark):
    df = spark.createDataFrame([("A", 1, "m", "c", "summary", None, 0, "f", "low"), ("A", 2, "m", "d", "linked", "B", 0, "g", "high")], "issue_key string, entry long, mode string, category string, place string, via string, pos long, fragment string, confidence string")
    got = r.dedupe_matches(df)
    assert all("/matches-" in f for f in got.inputFiles()) and got.inputFiles()
    assert [tuple(r) for r in got.collect()] == [("A", "m", "summary; linked B", "c, d", "f | g", "high", 2)]


def test_texts_are_searched_once(spark):
    """Each text is lower-cased once where it is searched, however many keywords there are; before, once for each and again in filters."""
    from millrace.operators import items
    from pyspark.sql import functions as F

    cols = "issue_key string, mode string, category string, summary string, description string, has_attachment boolean"
    issues = spark.createDataFrame([("a", "m", "c", None, "x The\ny", True), ("b", "m", "c", "the", None, False), ("c", "m", "c", None, None, None), ("d", "m", "c", "Public", "license", True)], cols)
    others = spark.createDataFrame([("a", "comment", 0, "the end"), ("c", "comment", 0, "the"), ("d", "linked", 5, None)], "issue_key string, place string, pos long, text string")
    got = items.find_matches(issues, ["the", "y", "public\nlicense"], others)
    assert sorted((r["issue_key"], r["place"], r["pos"], r["matched"], r["fragment"]) for r in got.collect()) == [
        ("a", "comment", 2, "the", "the end"), ("a", "description", 1, "the, y", "x The y"), ("b", "summary", 0, "the", "the"), ("d", "description", 1, "public\nlicense", "[Public] Public license"),
    ]
    plan = items.find_matches(issues, [f"word {i}" for i in range(20)], others).groupBy("place").agg(F.count("*"))._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("lower(") <= 5  # summary and description twice (also for the join), the other texts once
