"""Benchmark decontamination: BM25 over an inverted index of test items, with block-max WAND.

Every passage of every training text is a query against the index of test items. Scores are divided by the item's own
score, so one threshold holds for all items. Per term and block of items the index knows the highest score. The terms of
a passage that cannot reach the threshold together are left out at first; the sum of the other terms' block bounds rules
most blocks out, WAND walks the rest with its pivot, and retrieves every item at the threshold or above. A hit counts
after its question and its answer are both found in the text, word for word.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import give_back, or_null, small_batches, solid, written

WINDOW = 128  # words of a passage; passages start every half window
SHINGLE = 5
BLOCK = 2
PASS_ITEMS = 20_000  # items of one index; up to so many, the corpus is read once
CELLS = 1 << 20  # passages times blocks whose bounds are held at a time
SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, passage long, n_passages long"
WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def question_and_answer(text: str | None) -> tuple[list[str], list[str]]:
    """The words up to the last question mark and those after it; without one, the last third is the answer."""
    head, mark, tail = (text or "").rpartition("?")
    if mark and words_of(head) and words_of(tail):
        return words_of(head), words_of(tail)
    words = words_of(text)
    cut = len(words) - max(1, len(words) // 3)
    return words[:cut], words[cut:]


def shingles(words: list[str], n: int = SHINGLE) -> set[str]:
    """The runs of n words (all words, if fewer)."""
    return {" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


@dataclass
class ItemIndex:
    """items in order of their number; term t's postings are items[start[t] : start[t + 1]], ascending, with normalized
    scores; its blocks are blocks[block_start[t] : block_start[t + 1]], each with its highest score."""

    item_ids: list[int | None]
    parts: list[tuple[set[str], set[str]]]
    terms: dict[str, int]
    start: np.ndarray
    items: np.ndarray
    scores: np.ndarray
    block_start: np.ndarray
    blocks: np.ndarray
    block_max: np.ndarray
    term_max: np.ndarray
    least: np.ndarray  # threshold by item

    @property
    def n_blocks(self) -> int:
        return -(-len(self.item_ids) // BLOCK)

    @property
    def grams(self) -> set[str]:
        return {g for q, a in self.parts for g in q | a}

    def postings(self, term: int) -> tuple[list[int], list[float]]:
        at = slice(self.start[term], self.start[term + 1])
        return self.items[at].tolist(), self.scores[at].tolist()

    def bounds(self, term: int) -> dict[int, float]:
        at = slice(self.block_start[term], self.block_start[term + 1])
        return dict(zip(self.blocks[at].tolist(), self.block_max[at].tolist()))


@dataclass
class Statistics:
    """What BM25 knows of all items that hold a word: their number, mean length, and in how many a term stands."""

    n: int
    mean: float
    df: dict[str, int]


def statistics(words: list[list[str]]) -> Statistics:
    return Statistics(len(words), sum(map(len, words)) / len(words) if words else 1.0, Counter(t for w in words for t in set(w)))


def build_index(items: list[tuple[int | None, str | None]], *, whole: Statistics | None = None, threshold: float = 0.6, k1: float = 1.2, b: float = 0.75, window: int = WINDOW) -> ItemIndex:
    """Index (item_id, text) pairs. An item of more words than half a window needs the share of the threshold that half a window can hold.

    `whole` holds the statistics of all items if these are only some of them. Items without a word can't be found and
    are left out."""
    kept = sorted(((i, t) for i, t in items if words_of(t)), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    words = [words_of(t) for _, t in kept]
    whole, n_items = whole or statistics(words), len(kept)
    n, mean, df = whole.n, whole.mean, whole.df
    terms = {t: k for k, t in enumerate(sorted({t for w in words for t in w}))}
    lists: list[tuple[list[int], list[float]]] = [([], []) for _ in terms]
    for i, w in enumerate(words):
        own = {t: np.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * f * (k1 + 1) / (f + k1 * (1 - b + b * len(w) / mean)) for t, f in Counter(w).items()}
        total = sum(own.values())
        for t, s in own.items():
            lists[terms[t]][0].append(i)
            lists[terms[t]][1].append(s / total)
    size = np.array([len(at) for at, _ in lists], dtype=np.int64)
    numbers = np.array([i for at, _ in lists for i in at], dtype=np.int64)
    scores = np.array([x for _, s in lists for x in s], dtype=np.float64)
    term = np.repeat(np.arange(len(lists)), size)
    head = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (numbers[1:] // BLOCK != numbers[:-1] // BLOCK)]) if len(numbers) else np.empty(0, np.int64)
    top = np.maximum.reduceat(scores, head) if len(head) else scores
    offsets = lambda many: np.r_[0, np.cumsum(many)].astype(np.int64)
    start = offsets(size)
    least = np.array([threshold * min(1.0, window / 2 / len(w)) for w in words])
    cut = [question_and_answer(t) for _, t in kept]
    parts = []
    for q, a in cut:  # an answer's shingles may start in the question, so that short answers have any
        tail = (q[-(SHINGLE - 1) :] if len(a) < SHINGLE else []) + a
        parts.append((shingles(q), shingles(tail)))
    most = np.maximum.reduceat(scores, start[:-1]) if len(scores) else scores
    return ItemIndex([i for i, _ in kept], parts, terms, start, numbers, scores, offsets(np.bincount(term[head], minlength=len(lists))), numbers[head] // BLOCK, top * (1 + 1e-9), most * (1 + 1e-9), least)


def wand(index: ItemIndex, terms: list[int], blocks: np.ndarray) -> list[tuple[int, float]]:
    """Every item of the open blocks whose score over the distinct terms reaches its threshold.

    Cursors stand on each term's next item; the pivot is the first item that the bounds of the terms up to it can lift
    to the lowest threshold. A pivot whose block bounds fall short skips to the block's end.
    """
    lowest, opened = float(index.least.min()), blocks.tolist()
    found: list[tuple[int, float]] = []
    cursors = []
    for t in terms:
        at, s = index.postings(t)
        if (k := bisect_left(at, opened[0] * BLOCK)) < len(at):
            cursors.append([at[k], k, at, s, index.bounds(t), float(index.term_max[t])])
    while cursors:
        cursors.sort(key=itemgetter(0))
        bound, pivot = 0.0, -1
        for i, c in enumerate(cursors):
            bound += c[5]
            if bound >= lowest:
                pivot = i
                break
        if pivot < 0:
            break
        item = cursors[pivot][0]
        block = item // BLOCK
        next_open = bisect_left(opened, block)
        if next_open == len(opened):
            break
        if opened[next_open] != block:
            aim = opened[next_open] * BLOCK
        elif sum(c[4].get(block, 0.0) for c in cursors if c[0] // BLOCK <= block) < lowest:
            aim = (block + 1) * BLOCK
        elif cursors[0][0] == item:
            score = 0.0
            for c in cursors:
                if c[0] != item:
                    break
                score += c[3][c[1]]
            if score >= index.least[item]:
                found.append((item, score))
            aim = item + 1
        else:
            aim = item
        moved = []
        for c in cursors:
            if c[0] < aim:
                at = c[2]
                k = bisect_left(at, aim, c[1])
                if k == len(at):
                    continue
                c[0], c[1] = at[k], k
            moved.append(c)
        cursors = moved
    return found


def open_blocks(index: ItemIndex, passage: np.ndarray, term: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, blocks) of every passage, a stretch of the sorted pairs (passage, term), that some block's bound lets through."""
    lowest = float(index.least.min())
    starts = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
    ends = np.r_[starts[1:], len(passage)]
    step = max(1, CELLS // index.n_blocks)
    for lo in range(0, len(starts), step):
        hi = min(lo + step, len(starts))
        t = term[starts[lo] : ends[hi - 1]]
        row = np.repeat(np.arange(hi - lo) * index.n_blocks, ends[lo:hi] - starts[lo:hi])
        many = index.block_start[t + 1] - index.block_start[t]
        flat = np.repeat(index.block_start[t] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        bound = np.bincount(np.repeat(row, many) + index.blocks[flat], index.block_max[flat], (hi - lo) * index.n_blocks).reshape(hi - lo, -1)
        for k in np.flatnonzero(bound.max(axis=1) >= lowest):
            yield starts[lo + k], ends[lo + k], np.flatnonzero(bound[k] >= lowest)


def hits(index: ItemIndex, words: list[str], grams: set[str], *, window: int = WINDOW, least_question: float = 0.5, least_answer: float = 0.5, least_both: float = 0.6) -> list[tuple[int, float, float, float, int, int]]:
    """(item_id, best score, question overlap, answer overlap, first passage, passages) of every verified item of a text's words."""
    if not words or not index.item_ids:
        return []
    code = np.fromiter(map(index.terms.get, words, repeat(-1)), dtype=np.int64, count=len(words))
    where = np.flatnonzero(code >= 0)
    if not len(where):
        return []
    term = code[where]
    half, n_terms = window // 2, len(index.terms)
    last = max(0, (len(words) - 1) // half - 1) if len(words) > window else 0
    here, before = where // half, where // half - 1
    keys = np.concatenate([np.minimum(here, last) * n_terms + term, (np.maximum(before, 0) * n_terms + term)[before <= last]])
    keys = np.unique(keys)
    passage, term = keys // n_terms, keys % n_terms
    scores: dict[int, list[tuple[float, int]]] = defaultdict(list)
    for a, b, blocks in open_blocks(index, passage, term):
        for item, score in wand(index, term[a:b].tolist(), blocks):
            scores[item].append((score, int(passage[a])))
    if not scores:
        return []
    present = set()
    for i in range(max(1, len(words) - SHINGLE + 1)):
        if (g := " ".join(words[i : i + SHINGLE])) in grams:
            present.add(g)
    short = " " + " ".join(words) + " "
    out = []
    for item, found in sorted(scores.items()):
        question, answer = index.parts[item]
        share = [sum(g in present or (g.count(" ") < SHINGLE - 1 and f" {g} " in short) for g in part) / len(part) if part else 1.0 for part in (question, answer)]
        both = (share[0] * len(question) + share[1] * len(answer)) / (len(question) + len(answer))
        if share[0] >= least_question and share[1] >= least_answer and both >= least_both:
            out.append((index.item_ids[item], max(s for s, _ in found), share[0], share[1], min(p for _, p in found), len(found)))
    return out


def contaminated(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", threshold: float = 0.6) -> DataFrame:
    """One row per document and test item that it holds: score, overlaps, first passage and number of passages.

    One index holds up to PASS_ITEMS items, so neither driver nor tasks hold more; the corpus is read once for each, and
    every passage meets every index. Scores use the statistics of all items, however they are dealt. Null and blank texts hold nothing; repeated rows and equal items are each reported, with a null item_id too.
    """
    spark = docs.sparkSession
    rows = docs.select(solid(key).alias("doc_id"), F.col(text).alias("text"))
    out = None
    for index in _passes(items, item_key, item_text, threshold):
        shipped = spark.sparkContext.broadcast(index)

        def search(batches: Iterator[pd.DataFrame], shipped=shipped) -> Iterator[pd.DataFrame]:
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            for batch in batches:
                yield pd.DataFrame([(doc, *hit) for doc, t in zip(batch["doc_id"], batch["text"]) for hit in _found(shipped.value, t)], columns=names)
            give_back()

        found = rows.mapInPandas(search, SCHEMA).withColumns({"doc_id": or_null("doc_id"), "item_id": or_null("item_id")})
        out = found if out is None else out.unionAll(found)
    return out


def _passes(items: DataFrame, item_key: str, item_text: str, threshold: float = 0.6) -> Iterator[tuple[ItemIndex, set[str]]]:
    """The index of one pass over the corpus after the other: about PASS_ITEMS items each."""
    small_batches(items.sparkSession)

    @F.pandas_udf("array<string>")
    def split(texts: pd.Series) -> pd.Series:
        return pd.Series([words_of(t) for t in texts], dtype=object)

    own = written(items.select(solid(item_key).alias("item_id"), F.col(item_text).alias("text")).withColumn("words", split("text")).where(F.size("words") > 0), "items")
    n, mean = own.agg(F.count(F.lit(1)), F.avg(F.size("words"))).first()
    df = written(own.select(F.explode(F.array_distinct("words")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")), "frequencies")
    passes = max(1, -(-n // PASS_ITEMS))
    for k in range(passes):
        dealt = own.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k)
        terms = dealt.select(F.explode("words").alias("term")).distinct()
        whole = Statistics(n, mean or 1.0, {r["term"]: r["df"] for r in df.join(terms, "term", "left_semi").collect()})
        part = sorted(tuple(r) for r in dealt.select("item_id", "text").collect())
        index = build_index(part, whole=whole, threshold=threshold)
        yield index, index.grams


def _found(shipped: tuple[ItemIndex, set[str]], text: str | None) -> list[tuple]:
    index, grams = shipped
    return hits(index, words_of(text), grams)


def _free_of(shipped):
    @F.pandas_udf("boolean")
    def free(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series([not _found(shipped.value, t) for t in part], dtype=bool)
        give_back()

    return free


def clean(docs: DataFrame, items: DataFrame, *, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs without the rows that hold a test item. Works row by row, without a join; null ids are judged as well."""
    for index in _passes(items, item_key, item_text):
        shipped = docs.sparkSession.sparkContext.broadcast(index)
        docs = docs.where(_free_of(shipped)(F.col(text)))
    return docs
