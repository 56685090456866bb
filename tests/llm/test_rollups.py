"""Token count rollups against direct counts."""

import collections

import pytest

from millrace.llm import queries, rollups
from millrace.llm.common import scratch

ROWS = [(1, "a b c", "en", "s1"), (2, "a b c", "en", "s2"), (3, None, None, "s1"), (4, "", "en", None), (5, "x y", "de", "s1"), (5, "x y", "de", "s1"), (None, "x y", "de", "s1"), (6, "- - é", "de", "s1")]


def totals(df):
    return {(r["source"], r["lang"], r["tokenizer"]): (r["documents"], r["tokens"]) for r in df.collect()}


@pytest.fixture
def counts(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string").selectExpr("*", "1 AS tokens", "'x' AS tokenizer", "'x' AS digest")
    return rollups.count_tokens(docs, {"w": rollups.word_counter}).cache()


def direct(rows, count=rollups.word_counter):
    out = collections.defaultdict(lambda: [0, 0])
    for _, t, lang, source in rows:
        out[source, lang, "w"][0] += 1
        out[source, lang, "w"][1] += count(t or "")
    return {k: tuple(v) for k, v in out.items()}


def test_signed_batches_add_up(spark, counts):
    ledger = rollups.TokenLedger(spark, scratch(spark, "ledger"))
    assert totals(ledger.totals()) == {} and ledger.batches() == []
    assert ledger.commit("b1", rollups.signed(counts, 1)) and not ledger.commit("b1", rollups.signed(counts, 1))
    assert totals(ledger.totals()) == direct(ROWS)
    assert ledger.commit("b2", rollups.signed(rollups.copies(counts), -1))
    assert totals(ledger.totals()) == direct([r for r in ROWS if r[0] not in (2, 4, None)])
    ledger.commit("b3", rollups.signed(counts, 1))
    ledger.commit("b4", rollups.signed(counts, -1))
    ledger.commit("empty", rollups.signed(counts.limit(0), 1))
    assert totals(ledger.totals()) == direct([r for r in ROWS if r[0] not in (2, 4, None)])
    assert ledger.batches() == ["b1", "b2", "b3", "b4", "empty"]
    with pytest.raises(ValueError):
        ledger.commit("../x", rollups.signed(counts, 1))


def test_half_written_batch_does_not_count(spark, counts):
    ledger = rollups.TokenLedger(spark, scratch(spark, "ledger"))
    ledger.commit("b1", rollups.signed(counts, 1))
    files, mark = ledger._at("b1", "_SUCCESS")
    files.delete(mark, False)
    assert totals(ledger.totals()) == {} and ledger.commit("b1", rollups.signed(counts, 1))
    assert totals(ledger.totals()) == direct(ROWS)


def test_query_equals_direct_counts(spark, sf):
    got = totals(queries.op6_token_counts(spark, sf))
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    import public_tokenizers
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    coder.encode_special_tokens = True
    want, seen = collections.defaultdict(lambda: [0, 0]), set()
    for d in docs:
        if d["text"] in seen:
            continue
        seen.add(d["text"])
        for name, n in (("words-2", rollups.word_counter_2(d["text"])), ("word_bpe_49k", len(coder.encode(d["text"], add_special_tokens=False).ids))):
            want[d["source"], d["lang"], name][0] += 1
            want[d["source"], d["lang"], name][1] += n
    assert got == {k: tuple(v) for k, v in want.items()}
