"""Decontamination does not depend on how benchmark items are dealt to indexes."""

from millrace.llm import decontaminate
from tests.llm.test_operators import docs_of, prose


def test_scores_do_not_depend_on_the_index_size(spark, monkeypatch):
    items = [(k, prose(("i", k), 40)) for k in range(30)] + [(None, prose("null id", 40))]
    rows = [(k, f"{prose(k, 30)} {' '.join(t.split()[k % 12 :])} {prose(('e', k), 30)}") for k, (_, t) in enumerate(items)]
    bench, df = spark.createDataFrame(items, "item_id long, text string"), docs_of(spark, rows)
    found = lambda: sorted((r["doc_id"], -1 if r["item_id"] is None else r["item_id"], round(r["score"], 9)) for r in decontaminate.contaminated(df, bench).collect())
    want = found()
    assert any(i == -1 for _, i, _ in want)
    for n in (1000, 11, 4):
        monkeypatch.setattr(decontaminate, "PASS_ITEMS", n)
        monkeypatch.setattr(decontaminate, "CELLS", 8 * n)
        assert found() == want
    gone = {r["doc_id"] for r in df.collect()} - {r["doc_id"] for r in decontaminate.clean(df, bench).collect()}
    assert gone == {d for d, _, _ in want} and 30 in gone
