"""Shared and edited passages in random places, and the registered query against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
from millrace.llm import passages, queries, repeats
from tests.llm.test_operators import docs_of, prose


@pytest.mark.parametrize("words,least", [(24, 24), (51, 40), (60, 40), (200, 40)])
def test_every_unchanged_passage_goes_whole(spark, words, least):
    r, rows = random.Random(words), []
    for k in range(150):
        p = prose(("p", words, k), words)
        for c in range(2):
            rows.append((2 * k + c, f"{prose(('a', words, k, c), r.randrange(20, 90))} {p} {prose(('b', words, k, c), r.randrange(20, 90))}"))
    left = {x["doc_id"]: x["text"].split() for x in repeats.without_repeats(docs_of(spark, rows), least=least).collect()}
    before = {i: t.split() for i, t in rows}
    assert all(left[2 * k] == before[2 * k] and len(left[2 * k + 1]) <= len(before[2 * k + 1]) - words for k in range(150))


@pytest.mark.parametrize("at", [10, 30, 50])
def test_edited_passages(spark, at):
    rows = []
    for k in range(100):
        p = prose(("e", k), 60).split()
        q = [*p[:at], "changed", *p[at + 1 :]]
        rows += [(1000 + k, f"{prose(('a', k), 50)} {' '.join(p)} {prose(('b', k), 50)}"), (2000 + k, f"{prose(('c', k), 50)} {' '.join(q)} {prose(('d', k), 50)}")]
    left = {x["doc_id"]: x["text"] for x in repeats.without_repeats(docs_of(spark, rows)).collect()}
    whole = np.array(["changed" not in left[2000 + k] and len(left[2000 + k].split()) <= 100 for k in range(100)])
    found = np.array([len(left[2000 + k].split()) < 160 for k in range(100)])
    assert found.mean() >= 0.98 and whole.mean() >= 0.9


def test_shared_lines_stay(spark):
    line = prose("line", 25)
    rows = [(k, f"{prose(('x', k), 40)}\n{line}\n{prose(('y', k), 40)}") for k in range(20)]
    assert repeats.repeats(docs_of(spark, rows)).count() == 0
    assert {r["doc_id"] for r in repeats.repeats(docs_of(spark, rows), least=20).collect()} == set(range(20))


def words_of(text):
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def test_query_against_brute_force(spark, sf):
    """All runs of 50 words that an earlier document has are in passages; every passage is at 0.8 of its first document."""
    docs = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    docs.sort(key=lambda d: d["doc_id"])
    first, due = {}, defaultdict(set)
    for d in docs:
        w = words_of(d["text"])
        for k in range(len(w) - 49):
            g = hash(tuple(w[k : k + 50]))
            if first.setdefault(g, d["doc_id"]) != d["doc_id"]:
                due[d["doc_id"]].update(range(k, k + 50))
    got = defaultdict(set)
    text = {d["doc_id"]: words_of(d["text"]) for d in docs}
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    for r in queries.op5_repeats(spark, sf).collect():
        if r["kind"] == "passage":
            got[r["doc_id"]].update(range(r["run"], r["run"] + r["run_words"]))
            own = grams(text[r["doc_id"]][r["run"] : r["run"] + r["run_words"]])
            assert r["run_words"] >= repeats.LEAST and r["first_doc"] < r["doc_id"]
            assert len(own & grams(text[r["first_doc"]])) >= 0.8 * len(own)
    assert due and all(got[d] >= w for d, w in due.items())


def test_reach_goes_over_edits():
    a = np.arange(30, dtype=np.uint32)
    b = a.copy()
    b[7] = 99
    assert passages.reach(a, b) == [(0, 0, 7), (8, 8, 22)]
    assert passages.reach(a, np.r_[a[:5], a[6:20]]) == [(0, 0, 5), (6, 5, 14)]
    assert passages.reach(a, a[::-1].copy()) == []


def test_joined_spans():
    assert passages.joined_spans([(0, 10, 30), (31, 41, 29)]) == [(0, 10, 60, 60)]
    assert passages.joined_spans([(0, 10, 14), (60, 70, 14)]) == [(0, 10, 14, 14), (60, 70, 14, 14)]
    assert passages.joined_spans([(0, 10, 20), (5, 15, 20), (5, 15, 20)]) == [(0, 10, 25, 25)]
