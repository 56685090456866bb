"""The Merkle manifest against a plain recursion."""

import zlib
from hashlib import sha256

import pytest
from millrace.llm import merkle, queries
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CAPITALS = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def h(*parts):
    return sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def leaf(i, text, lang, source, n):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)])


def tree(nodes):
    """The top of nodes and the proof (siblings before and after, by level) of each."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            first = i - i % 16
            proofs[k].append((nodes[first:i], nodes[i + 1 : first + 16]))
        at = [i // 16 for i in at]
        nodes = [h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], proofs


def plain(rows):
    """The result's rows for (doc_id, text, lang, source, n_chars)."""
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    subs = {}
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        subs[s] = tree([leaf(*r) for r in by[s]])
    root, tops = tree([subs[s][0] for s in order])
    out = []
    for s, above in zip(order, tops):
        for r, proof in zip(by[s], subs[s][1]):
            shown = r
            if r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                shown = (r[0], r[1].translate(CAPITALS), *r[2:])
            node = leaf(*shown)
            for left, right in proof + above:
                node = h(*left, node, *right)
            said = h(*[x for left, right in proof + above for x in left + right])
            out.append((r[0], leaf(*r), subs[s][0], root, said, node, node == root))
    return sorted(out, key=str)


def found(rows, **more):
    shown = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, merkle.without_capitals(F.col("text")))
    got = merkle.manifest(merkle.leaves(rows, tampered=shown), **more).collect()
    return sorted(((r["id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) for r in got), key=str)


def odd_rows(n=700):
    rows = [(i, f"Text {i} ÄÖ É" if i % 7 else None, "en" if i % 3 else None, ["hot", "hot", "b", "é", None, f"one-{i}"][i % 6], i if i % 5 else None) for i in range(n)]
    return rows + [(3, "again", "en", "hot", 1), (3, "again", "en", "hot", 1), (None, "NO ID", None, "hot", None), (None, None, None, None, None), (5, "", "", "", 0), (-9, "Below zero", "en", "hot", 3), (11, "A " * 200_000, "en", "b", 1)]


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_equals_plain_recursion(spark, levels):
    rows = odd_rows()
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("id", "pos", "leaf", "tree", "block", "total", "shown", "root", "level")})
    assert found(df, levels=levels) == plain(rows)


def test_small_and_empty(spark):
    for rows in ([(1, "Lone", "en", "s", 4)], [(1, "A", None, "s", 1), (2, "B", None, "t", 1)], [(i, "Same", None, None, 4) for i in [8] * 40]):
        assert found(spark.createDataFrame(rows, DOCS)) == plain(rows)
    assert found(spark.createDataFrame([], DOCS)) == []


def test_proofs_fold_to_the_root(spark):
    rows = odd_rows(60)
    got = merkle.manifest(merkle.leaves(spark.createDataFrame(rows, DOCS)), with_proofs=True).collect()
    assert all(r["verified"] and h(r["proof"]) == r["proof_sha256"] and len(r["proof"]) % 64 == 0 for r in got)


def test_query_over_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    got = queries.op11_merkle(spark, sf)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain([tuple(r) for r in docs.collect()])
