"""Whole passages from lined-up stretches of paragraphs: extended word by word, bridged over edits, verified.

A stretch ends where its paragraphs do, up to a few words inside the passage that two texts share. The words around
both its ends are compared in both texts, over changed words as well; stretches of the same two texts with a gap between
them become one passage if its five-word Jaccard is SIMILAR or more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import dropped, give_back, slices, written
from millrace.llm.verify import SIMILAR, matched

SHINGLE = 5
CONTEXT = 32  # words known on either side of a stretch: two gaps between cuts
STEPS = ((1, 1), (1, 0), (0, 1), (2, 2), (2, 1), (1, 2), (3, 3))  # words changed, added or left out at an edit
PIECE = 1 << 19
SPAN = "doc_id long, row long, first_doc long, first_row long, start int, first_start int, words int, component long"
PASSAGE = "doc_id long, row long, first_doc long, first_row long, start int, first_start int, words int, first_words int, component long"


def reach(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (place in a, place in b, words) that two surroundings have in common from their beginning on.

    After an edit of a few words, the comparison goes on where SHINGLE words agree again.
    """
    i = j = 0
    out = []
    while True:
        n = min(len(a) - i, len(b) - j)
        differ = np.flatnonzero(a[i : i + n] != b[j : j + n])
        same = int(differ[0]) if len(differ) else n
        if same:
            out.append((i, j, same))
        i, j = i + same, j + same
        for x, y in STEPS:
            if len(a) >= i + x + SHINGLE and len(b) >= j + y + SHINGLE and (a[i + x : i + x + SHINGLE] == b[j + y : j + y + SHINGLE]).all():
                i, j = i + x, j + y
                break
        else:
            return out


def joined_spans(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, first_start, words, first_words) of the passages that exact spans (start, first_start, words) of one pair of texts make up."""
    exact: list[list[int]] = []
    open_at: dict[int, int] = {}  # the last span by offset between the two texts
    for s, f, n in sorted(set(found)):
        k = open_at.get(s - f)
        if k is not None and s <= exact[k][0] + exact[k][2]:
            exact[k][2] = max(exact[k][2], s + n - exact[k][0])
        else:
            open_at[s - f] = len(exact)
            exact.append([s, f, n])
    chains: list[list[list[int]]] = []
    for x in exact:
        last = chains[-1][-1] if chains else None
        if last and x[0] >= last[0] + last[2] and x[1] >= last[1] + last[2]:
            chains[-1].append(x)
        else:
            chains.append([x])
    out = []
    while chains:
        c = chains.pop()
        a, b = c[-1][0] + c[-1][2] - c[0][0], c[-1][1] + c[-1][2] - c[0][1]
        both = sum(max(0, n - SHINGLE + 1) for _, _, n in c)
        if len(c) == 1 or both >= SIMILAR * (a + b - 2 * (SHINGLE - 1) - both):
            out.append((c[0][0], c[0][1], a, b))
        else:  # apart at the widest gap
            gaps = [max(y[0] - x[0], y[1] - x[1]) - x[2] for x, y in zip(c, c[1:])]
            k = gaps.index(max(gaps)) + 1
            chains += [c[:k], c[k:]]
    return sorted(out)


def surroundings(rows: DataFrame, stretches: DataFrame) -> DataFrame:
    """The ends of all stretches in both their texts, in one pass over the texts: doc_id, row, start, words, before, after
    (hashes of up to CONTEXT words before the stretch, nearest first, and after it, four bytes a word).

    A stretch's own end (`own`) carries the rest of the stretch, so it needs no join to come back to it; the end in the
    first document, which many stretches may share, has zeros there. Repeated rows of a document give repeated ends.
    """
    rest = ["first_doc", "first_row", "first_start", "first_words", "component"]
    ends = stretches.select("doc_id", "row", F.struct("start", "words", *rest, F.lit(True).alias("own")).alias("end"))
    zeros = [F.lit(0).cast(stretches.schema[c].dataType).alias(c) for c in rest]
    firsts = stretches.select(F.col("first_doc").alias("doc_id"), F.col("first_row").alias("row"), F.struct(F.col("first_start").alias("start"), F.col("first_words").alias("words"), *zeros, F.lit(False).alias("own")).alias("end"))
    wanted = written(ends.unionAll(firsts).groupBy("doc_id", "row").agg(F.collect_set("end").alias("wanted")), "wanted")
    held = wanted.agg(F.count(F.lit(1)) + F.coalesce(F.sum(F.size("wanted")), F.lit(0))).first()[0]
    asked = matched(rows, wanted, held, ["doc_id", "row"], F.xxhash64("doc_id", "row")).select("doc_id", "row", "text", "wanted")

    def around(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        digest = xxhash.xxh64_intdigest
        for batch in batches:
            for a, b in slices(batch["text"].str.len().fillna(0).astype(int).tolist(), PIECE):
                out = []
                for d, r, t, ends in zip(*(batch[c].iloc[a:b] for c in ("doc_id", "row", "text", "wanted"))):
                    words = (t or "").encode("utf-8", "surrogatepass").lower().split()
                    hashed = lambda part: np.array([digest(w) & 0xFFFFFFFF for w in part], dtype="<u4").tobytes()
                    for x in ends:
                        s, e = x["start"], x["start"] + x["words"]
                        out.append((d, r, s, e - s, hashed(words[max(0, s - CONTEXT) : s][::-1]), hashed(words[e : e + CONTEXT]), *(x[c] for c in rest), x["own"]))
                yield pd.DataFrame(out, columns=["doc_id", "row", "start", "words", "before", "after", *rest, "own"])
        give_back()

    found = written(asked.mapInPandas(around, "doc_id long, row long, start int, words int, before binary, after binary, first_doc long, first_row long, first_start int, first_words int, component long, own boolean"), "surroundings")
    dropped(wanted)
    return found


def extended(rows: DataFrame, stretches: DataFrame, *, least: int) -> DataFrame:
    """The passages of `least` words or more that the stretches are part of (columns of PASSAGE)."""
    known = surroundings(rows, stretches)
    theirs = known.where("not own").dropDuplicates(["doc_id", "row", "start", "words"])
    theirs = theirs.select(*(F.col(a).alias(b) for a, b in (("doc_id", "first_doc"), ("row", "first_row"), ("start", "first_start"), ("words", "first_words"), ("before", "before2"), ("after", "after2"))))
    theirs = written(theirs, "theirs")  # read from there, the join below may split a hot passage
    both = known.where("own").drop("own").join(theirs, ["first_doc", "first_row", "first_start", "first_words"])

    def grown(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            out = []
            for d, r, d1, r1, s, s1, n, n1, of, before, after, before2, after2 in zip(*(x[c].tolist() for c in x.columns)):
                own = (d, r, d1, r1)
                if n:
                    out.append((*own, s, s1, n, of))
                out += [(*own, s - i - k, s1 - j - k, k, of) for i, j, k in reach(np.frombuffer(before, "<u4"), np.frombuffer(before2, "<u4"))]
                out += [(*own, s + n + i, s1 + n1 + j, k, of) for i, j, k in reach(np.frombuffer(after, "<u4"), np.frombuffer(after2, "<u4"))]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SPAN.split(", ")])

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, found, of = None, [], None
        for batch in batches:
            out = []
            for d, r, d1, r1, s, f, n, component in zip(*(batch[c].tolist() for c in batch.columns)):
                if (d, r, d1, r1) != key:
                    out += [(*key, *x, of) for x in joined_spans(found) if x[2] >= least] if found else []
                    key, found, of = (d, r, d1, r1), [], component
                found.append((s, f, n))
                of = min(of, component)
            yield pd.DataFrame(out, columns=[c.split()[0] for c in PASSAGE.split(", ")])
        if found:
            yield pd.DataFrame([(*key, *x, of) for x in joined_spans(found) if x[2] >= least], columns=[c.split()[0] for c in PASSAGE.split(", ")])
        give_back()

    names = ["doc_id", "row", "first_doc", "first_row", "start", "first_start", "words", "first_words", "component", "before", "after", "before2", "after2"]
    spans = both.select(names).mapInPandas(grown, SPAN)
    out = written(spans.repartition("doc_id", "row").sortWithinPartitions("doc_id", "row", "first_doc", "first_row").mapInPandas(merged, PASSAGE), "passages")
    dropped(known, theirs, stretches)
    return out
