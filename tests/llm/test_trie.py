"""The prefix trie against plain dictionaries."""

import random
import zlib
from hashlib import sha256

import pytest
from millrace.llm import queries, trie
from pyspark.sql import functions as F
from tests.oracle import connection, differs

TURNS = "conv_id long, turn long, role string, text string"


def turn_hash(role, text):
    return sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def plain(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    for c in own:
        own[c] = [x[2:] for x in sorted(own[c], key=lambda x: (x[0], x[1], signed(turn_hash(*x[2:]))))]
    return nodes_of({c: own.get(c - int(__import__("math").fmod(c, 5)), [])[: (h := zlib.crc32(str(c).encode()) % 9)] + own[c][h:] for c in own})


def signed(hexed):
    return [int.from_bytes(bytes.fromhex(hexed[a : a + 16]), "big", signed=True) for a in (0, 16)]


def nodes_of(paths):
    """The result's rows for {conv_id: [(role, text)]}."""
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids.get(p, [])) or 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0) + sum(saved[k] for k in kids.get(p, []))
    ends = {}
    for c in sorted(paths):
        ends.setdefault(tuple(paths[c]), []).append(str(c))
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p], sha256(",".join(ends.get(p, [])).encode()).hexdigest()) for p, m in members.items() if True) if members else []


def found(df, **more):
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    got = trie.prefix_trie(trie.with_shared_heads(trie.turn_lists(df), group=5, most=8, head=head), **more).collect()
    return sorted(((r["conv_id"], r["depth"], r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in got), key=lambda x: tuple((v is not None, v) for v in x))


def order(rows):
    return sorted(rows, key=lambda x: tuple((v is not None, v) for v in x))


def turns(n=300, seed=1):
    r, rows = random.Random(seed), []
    for c in range(-20, n):
        for t in range(r.randrange(0, 9)):
            rows.append((c, t, r.choice(["user", "assistant"]), r.choice("abc") * r.randrange(1, 3)))
    rows += [(1000 + 5 * k, t, "user", f"the same {t}") for k in range(60) for t in range(5)]  # a hot group of copies
    rows += [(2000, None, None, None), (2000, 3, "x", None), (2000, 3, "x", "tie"), (2000, 3, "x", "tie"), (2001, 1, "user", "é" * 50_000), (None, 1, "user", "no id")]
    rows += [(2003, 0, "user", "its base is not there"), (2005, 0, "", ""), (2005, 1, "", "")]
    return rows + [(3000 + 5 * k, t, "u", f"deep {t}") for k in range(4) for t in range(30 + k)]


@pytest.mark.parametrize("cells, deep", [(1 << 20, 64), (40, 64), (40, 3), (1, 1)])
def test_equals_plain_dictionaries(spark, cells, deep):
    rows = turns()
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("x") for c in ("key", "turns", "depth", "size", "hi", "lo", "up", "ends")})
    assert found(df, cells=cells, deep=deep) == order(plain(rows))


def test_one_and_none(spark):
    for rows in ([], [(None, 1, "u", "t")], [(7, 1, "u", "t")], [(4, 0, "u", "t")], [(i, 0, "u", "t") for i in range(50)]):
        assert found(spark.createDataFrame(rows, TURNS)) == order(plain(rows))


def test_query_equals_its_sql(spark, sf):
    assert differs(queries.op12_trie(spark, sf), connection(sf), queries.oracle_sql()["op12_trie"]) is None
