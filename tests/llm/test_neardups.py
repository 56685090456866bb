"""The pipeline's near copies against brute force."""

import random

import corpus_pipeline
import pytest
from millrace.llm import neardups
from tests.llm.test_operators import ODD, docs_of, prose


def plain_shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def groups_of(texts):
    """The component of each text by all pairs of Jaccard 0.8 or more, and the number of such pairs of different texts."""
    sets, root, pairs = [plain_shingles(t) for t in texts], list(range(len(texts))), set()
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b):
                pairs.add((j, i))
                old, new = root[i], root[j]
                root = [new if x == old else x for x in root]
    return root, pairs


def test_one_changed_word_is_a_near_copy(spark, sf):
    words = prose("base", 300).split()
    near = " ".join(words[:150] + ["changed"] + words[151:])
    rows = [(1, " ".join(words)), (2, near), (3, prose("other", 300))]
    assert {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs_of(spark, rows, extra=True), sf).collect()} == {1, 3}


@pytest.mark.parametrize("together", [2, 5, 128])
def test_representatives_equal_brute_force(spark, monkeypatch, together):
    monkeypatch.setattr(neardups, "BLOCK", 300)
    r, rows = random.Random(1), [x for x in ODD if x[0] is not None]
    for k in range(12):
        words = prose(("n", k), 120).split()
        for c in range(8):
            own = list(words)
            for at in r.sample(range(120), r.randrange(0, 5)):
                own[at] = f"new{k}x{c}x{at}"
            rows.append((1000 + 10 * k + c, " ".join(own)))
    rows += [(None, rows[-1][1]), (None, "no id at all, twice"), (None, "no id at all, twice"), (4, "an unrelated text of the same id")]
    root, _ = groups_of([t for _, t in rows])
    want = {}
    for (i, t), k in zip(rows, root):
        want[k] = min(want.get(k, (True, 0)), (i is None, i or 0))
    kept = neardups.representatives(docs_of(spark, rows, extra=True), together=together).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept) == sorted(want.values())
    assert neardups.representatives(docs_of(spark, [])).count() == 0


def test_recall_of_bands(spark):
    import numpy as np

    r, texts = random.Random(2), []
    for k in range(400):  # pairs at 0.8 to 0.83: four or five changed words of 200, apart
        words = prose(("r", k), 200).split()
        own = list(words)
        for at in r.sample(range(5, 195, 10), 4):
            own[at] = "changed"
        texts += [" ".join(words), " ".join(own)]
    h, many = neardups.word_hashes(texts)
    bands = neardups.bands_of(h, many)
    pairs = [(a, a + 1) for a in range(0, 800, 2) if len(plain_shingles(texts[a]) & plain_shingles(texts[a + 1])) >= 0.8 * len(plain_shingles(texts[a]) | plain_shingles(texts[a + 1]))]
    assert len(pairs) > 300 and np.mean([(bands[a] == bands[b]).any() for a, b in pairs]) >= 0.995
