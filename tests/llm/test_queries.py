"""The registered corpus queries and the pipeline over the smallest tables."""

import collections

import corpus_pipeline
from millrace.llm import decontaminate, queries
from tests.oracle import connection, differs


def test_top_k_equals_its_sql(spark, sf):
    assert differs(queries.op1_top_k(spark, sf), connection(sf), queries.oracle_sql()["op1_top_k"]) is None


def test_contract_columns(spark, sf):
    want = {
        "op2_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}, "op3_simhash": {"doc_id", "fingerprint", "component_id"},
        "op4_language_id": {"doc_id", "held_out", "lang_pred", "score"}, "op5_repeats": {"doc_id"}, "op7_decontamination": {"doc_id", "item_id"},
        "op8_main_text": {"page_id", "url", "text", "n_chars"}, "op9_warc": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"}, "op10_quality": {"doc_id", "held_out", "score", "predicted"},
    }
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name, cols in want.items():
        rows = queries.queries()[name](spark, sf)
        assert cols <= set(rows.columns), name
        if name in ("op3_simhash", "op4_language_id", "op10_quality"):
            assert rows.count() == n


def test_decontamination_equals_brute_force(spark, sf):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet").collect(), spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    grams = collections.defaultdict(set)
    for i in items:
        w = decontaminate.words_of(i["text"])
        for k in range(len(w) - 7):
            grams[tuple(w[k : k + 8])].add(i["item_id"])
    want = set()
    for d in docs:
        w, seen = decontaminate.words_of(d["text"]), collections.Counter()
        for k in range(len(w) - 7):
            seen.update((i, g) for g in [tuple(w[k : k + 8])] for i in grams.get(g, ()))
        share = collections.Counter(i for i, _ in seen)
        want |= {(d["doc_id"], i) for i, n in share.items() if n >= 0.6 * sum(1 for g in grams.values() if i in g)}
    assert {(r["doc_id"], r["item_id"]) for r in queries.op7_decontamination(spark, sf).collect()} == want


def test_pipeline_keeps_columns_and_shrinks(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before, cols = docs.count(), docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, sf), name)
        assert docs.columns == cols and 0.7 * before < docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    ids = {r["doc_id"] for r in packed.select("doc_id").distinct().collect()}
    assert ids == {r["doc_id"] for r in docs.select("doc_id").collect()}
    leaks = {r["doc_id"] for r in queries.op7_decontamination(spark, sf).collect()}
    assert not ids & leaks
