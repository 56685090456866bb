"""Substring dedup: paragraph MinHash banding.

Texts are cut into short paragraphs where the words say so: at the least word pair of every GAP successive ones, so a
passage that is copied into the middle of another text is cut alike there, and every shared run of 2*GAP+2 words has two
cuts in common. Paragraphs get MinHash signatures over five-word shingles; bands of them make candidates; candidates are
verified by exact Jaccard; components of verified links share a paragraph. A document's paragraphs are lined up with
those of the first document of their components; passages.py extends each stretch word by word and verifies it whole.
All but the first document lose a passage that is long enough.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import verify
from millrace.llm.common import dropped, give_back, mixed, or_null, slices, small_batches, solid, written
from millrace.llm.components import connected_components
from millrace.llm.sieve import Bits, Sieve
from millrace.llm.verify import SIMILAR, matched, maybe_sent, verified_links

LEAST = 40  # words of a passage that counts as a repeat: more than a shared line
SHINGLE = 5
LONGEST = 64
BANDS, ROWS = 4, 2  # 1 - (1 - 0.8**2)**4 = 0.983 of the pairs at the threshold collide, 0.999 at 0.9
LEAST_BANDED = 9  # words: two different paragraphs of fewer have no Jaccard of 0.8 (four shingles at most, one differs)
TOGETHER = 128  # paragraphs of a bucket that are compared in one go
PIECE = 1 << 19  # characters cut at a time
SENT_OUT = 4_000_000  # signatures of 8 bytes that may be broadcast; beyond, a filter of them


def gap_of(least: int) -> int:
    """Word pairs among which one is a cut, so that passages of `least` words hold whole paragraphs."""
    return max(2, 2 * least // 5)


# --- paragraphs -----------------------------------------------------------------------------------------------------


@dataclass
class Cut:
    """The paragraphs of several texts, text after text: where they start, their words, and the text that each is of."""

    hashes: np.ndarray  # of all words
    starts: np.ndarray
    size: np.ndarray
    owner: np.ndarray
    begin: np.ndarray  # the first word of each text

    @property
    def number(self) -> np.ndarray:
        """Of each paragraph, within its text."""
        first = np.flatnonzero(np.r_[True, self.owner[1:] != self.owner[:-1]])
        return np.arange(len(self.owner)) - np.repeat(first, np.diff(np.r_[first, len(self.owner)]))

    @property
    def place(self) -> np.ndarray:
        """Words before each paragraph in its text."""
        return self.starts - self.begin[self.owner]

    @property
    def signature(self) -> np.ndarray:
        place = np.arange(len(self.hashes), dtype=np.uint64) - np.repeat(self.starts, self.size).astype(np.uint64)
        return mixed(np.add.reduceat(mixed(self.hashes + mixed(place, 4), 5), self.starts) + self.size.astype(np.uint64)).view(np.int64)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and how many each has. Words are runs without ASCII blanks, A-Z in lower case."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    many = np.array([len(w) for w in words], dtype=np.int64)
    return np.fromiter((digest(w) for own in words for w in own), dtype=np.uint64, count=int(many.sum())), many


def _over(x: np.ndarray, size: int, best: np.ufunc) -> np.ndarray:
    """The least (or greatest) of every `size` successive values, by doubling."""
    step = 1
    while 2 * step <= size:
        x = best(x[:-step], x[step:])
        step *= 2
    return best(x[: len(x) - (size - step)], x[size - step :]) if size > step else x


def cut(texts: list[str | None], gap: int = gap_of(LEAST)) -> Cut:
    """Cut texts into paragraphs at the least pair hash of every `gap` successive pairs of a text."""
    h, many = word_hashes(texts)
    n, none = len(h), np.empty(0, np.int64)
    begin = np.cumsum(many) - many
    if not n:
        return Cut(h, none, none, none, begin)
    text = np.repeat(np.arange(len(texts)), many)
    firsts = begin[many > 0]
    before = np.r_[np.uint64(0), h[:-1]]
    before[firsts] = 0
    pair = mixed(h + mixed(before, 1), 2)
    chosen = np.zeros(n, bool)
    if n >= gap:
        least = _over(pair, gap, np.minimum)
        least[text[: n - gap + 1] != text[gap - 1 :]] = 0  # windows over the end of a text decide nothing
        edge = np.zeros(gap - 1, np.uint64)
        chosen = pair == _over(np.concatenate([edge, least, edge]), gap, np.maximum)
    chosen[firsts] = True
    at = np.flatnonzero(chosen)
    near = np.diff(np.r_[at, n]) < max(2, gap // 4)  # too short a paragraph is part of the one before
    starts = at[~near | np.isin(at, firsts)]
    size = np.diff(np.r_[starts, n])
    if (size > LONGEST).any():
        starts = np.concatenate([np.arange(a, a + g, LONGEST) for a, g in zip(starts, size)])
        size = np.diff(np.r_[starts, n])
    return Cut(h, starts, size, text[starts], begin)


def _shingles(h: np.ndarray) -> np.ndarray:
    """Hash of the shingle that starts at each word."""
    out = np.zeros(max(0, len(h) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        with np.errstate(over="ignore"):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(out)]
    return mixed(out, 3)


def _flat(starts: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs start..start+many-1 one after the other, and where each begins."""
    begin = np.cumsum(many) - many
    return np.repeat(starts - begin, many) + np.arange(many.sum()), begin


def bands_of(c: Cut) -> np.ndarray:
    """A row of band keys per paragraph; zeros for those under LEAST_BANDED words."""
    bands = np.zeros((len(c.starts), BANDS), np.uint64)
    banded = np.flatnonzero(c.size >= LEAST_BANDED)
    if len(banded):
        at, begin = _flat(c.starts[banded], c.size[banded] - SHINGLE + 1)
        own = _shingles(c.hashes)[at]
        for b in range(BANDS):
            key = np.full(len(banded), b, np.uint64)
            for r in range(ROWS):
                key = mixed(key * np.uint64(31) + np.minimum.reduceat(mixed(own, 100 + b * ROWS + r), begin))
            bands[banded, b] = key
    return bands.view(np.int64)


def shingle_sets(texts: list[str | None], wanted: np.ndarray | Bits | None, gap: int = gap_of(LEAST)) -> dict[int, np.ndarray]:
    """Distinct shingle hashes by signature of the paragraphs that are wanted (sorted signatures, or a filter of them; None: all with bands)."""
    c = cut(texts, gap)
    if not len(c.starts):
        return {}
    sig, grams = c.signature, _shingles(c.hashes).view(np.int64)
    pick = c.size >= LEAST_BANDED
    if isinstance(wanted, Bits):
        pick &= wanted.holds(sig)
    elif wanted is not None:
        pick &= len(wanted) > 0 and wanted[np.minimum(np.searchsorted(wanted, sig), len(wanted) - 1)] == sig
    return {int(sig[k]): np.unique(grams[c.starts[k] : c.starts[k] + c.size[k] - SHINGLE + 1]) for k in np.flatnonzero(pick)}


def without(text: str | None, runs: Iterable[tuple[int, int]]) -> str:
    """The text without the runs (start, words); what stays keeps its own blanks."""
    import re

    data = (text or "").encode("utf-8", "surrogatepass")
    spans = [m.span() for m in re.finditer(rb"[^ \t\n\r\x0b\x0c]+", data)]
    gone = np.zeros(len(spans) + 2, bool)  # one on either side, for the edges
    for start, n in runs:
        gone[start + 1 : min(start + n, len(spans)) + 1] = True
    edges = np.flatnonzero(gone[1:] != gone[:-1]).tolist()
    kept, last = [], 0
    for a, b in zip(edges[::2], edges[1::2]):
        kept.append(data[last : spans[a][0]])
        last = spans[b][0] if b < len(spans) else len(data)
    kept.append(data[last:])
    return b"".join(kept).decode("utf-8", "surrogatepass")


# --- links between paragraphs ---------------------------------------------------------------------------------------


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(solid(key).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("row"), F.col(text).alias("text"))


def paragraph_table(rows: DataFrame, gap: int = gap_of(LEAST)) -> DataFrame:
    """doc_id, row, number, start, words, sig and band0, band1... (0 for paragraphs under LEAST_BANDED words) of every paragraph."""

    def cut_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in slices(batch["text"].str.len().fillna(0).astype(int).tolist(), PIECE):
                c = cut(batch["text"].iloc[a:b].tolist(), gap)
                if not len(c.starts):
                    continue
                bands = bands_of(c)
                out = {"doc_id": batch["doc_id"].to_numpy()[a:b][c.owner], "row": batch["row"].to_numpy()[a:b][c.owner], "number": c.number, "start": c.place, "words": c.size, "sig": c.signature}
                yield pd.DataFrame(out | {f"band{k}": bands[:, k] for k in range(BANDS)})
        give_back()

    return rows.mapInPandas(cut_all, "doc_id long, row long, number int, start int, words int, sig long, " + ", ".join(f"band{b} long" for b in range(BANDS)))


def similar_links(rows: DataFrame, table: DataFrame, gap: int = gap_of(LEAST)) -> DataFrame:
    """Links (a, b) between different paragraph texts (signatures) of Jaccard SIMILAR or more that share a band."""
    bands = [F.col(f"band{b}") for b in range(BANDS)]
    banded = table.where(F.col("words") >= LEAST_BANDED)
    keyed = banded.select("sig", F.explode(F.array(*bands)).alias("key"))
    shared = written(keyed.groupBy("key").agg(F.min("sig").alias("lo"), F.max("sig").alias("hi")).where("lo < hi").select("key"), "bands")
    n_shared = shared.count()
    if n_shared > verify.SENT_OUT:  # most bands stand alone: they leave before the join shuffles them
        sieve = Sieve(shared, "key", n_shared)
        some = banded.select("sig", *bands, *[sieve.holds(band).alias(f"held{b}") for b, band in enumerate(bands)])
        keyed = some.select("sig", F.explode(F.array_compact(F.array(*[F.when(F.col(f"held{b}"), band) for b, band in enumerate(bands)]))).alias("key"))
    members = written(keyed.join(maybe_sent(shared, n_shared), "key").groupBy("key", "sig").agg(F.count(F.lit(1)).alias("c")), "members")
    wanted = written(members.select("sig").distinct(), "wanted")
    n_wanted = wanted.count()
    # one text for each wanted paragraph gives its shingles; other texts are not cut again
    places = written(matched(table.select("sig", "row"), wanted, n_wanted, ["sig"]).groupBy("sig").agg(F.min("row").alias("row")).select("row").distinct(), "places")
    givers = matched(rows, places, places.count(), ["row"], how="left_semi").select("text")
    ids = rows.sparkSession.sparkContext.broadcast(np.sort(wanted.toArrow().column("sig").to_numpy())) if n_wanted <= SENT_OUT else Sieve(wanted, "sig", n_wanted).sent

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in slices(batch["text"].str.len().fillna(0).astype(int).tolist(), PIECE):
                found = shingle_sets(batch["text"].iloc[a:b].tolist(), ids.value, gap)
                yield pd.DataFrame({"sig": np.array(list(found), np.int64), "shingles": list(found.values())})
        give_back()

    got = givers.mapInPandas(sets, "sig long, shingles array<long>")
    bodies = written((got if n_wanted <= SENT_OUT else got.join(wanted, "sig", "left_semi")).dropDuplicates(["sig"]), "bodies")
    ids.unpersist()
    # Equal sets (a word repeated more or less often) are linked at once; one of them stands for all.
    equal = written(bodies.groupBy("shingles").agg(F.min("sig").alias("sig"), F.collect_set("sig").alias("sigs")), "equal")
    same = equal.where(F.size("sigs") > 1).select(F.explode("sigs").alias("b"), F.col("sig").alias("a"))
    same = written(same.where("a <> b").select("a", "b"), "same")
    one = members.join(maybe_sent(same, same.count()), members["sig"] == same["b"], "left").groupBy("key", F.coalesce("a", "sig").alias("sig")).agg(F.sum("c").alias("c"))
    grouped = F.count(F.lit(1)).alias("n")
    sizes = one.groupBy("key").agg(grouped).where("n > 1")
    sized = written(one.join(sizes, "key"), "sized")
    few = sized.where(F.col("n") <= TOGETHER).select("key", "n", "sig", "c")
    groups = few
    if sized.where(F.col("n") > TOGETHER).limit(1).count():
        # Larger buckets: two sets of Jaccard s or more share one of their rarest shingles, floor((1-s)|set|)+1 of them.
        grams = sized.where(F.col("n") > TOGETHER).join(bodies, "sig").select("key", "sig", "c", F.explode("shingles").alias("gram"))
        rank = F.row_number().over(Window.partitionBy("key", "sig").orderBy("df", "gram"))
        size = F.count(F.lit(1)).over(Window.partitionBy("key", "sig"))
        rare = grams.join(grams.groupBy("key", "gram").agg(F.count(F.lit(1)).alias("df")), ["key", "gram"]).withColumns({"rank": rank, "size": size})
        prefix = rare.where((F.col("rank") <= F.floor(F.col("size") * (1 - SIMILAR) + 1e-9) + 1) & (F.col("df") > 1)).select("key", "sig", "gram", "c")
        met = prefix.groupBy("key", "gram").agg(grouped).where("n > 1")
        groups = written(few.unionAll(prefix.join(met, ["key", "gram"]).select(F.xxhash64("key", "gram").alias("key"), "n", "sig", "c")), "groups")
    links = written(verified_links(groups, bodies, together=TOGETHER).unionAll(same), "similar")
    dropped(shared, members, wanted, places, bodies, equal, same, sized)
    return links


# --- repeats --------------------------------------------------------------------------------------------------------


LINED_UP = "doc_id long, row long, first_doc long, first_row long, start int, first_start int, words int, first_words int, component long"


def lined_up(docs: DataFrame, *, key: str = "doc_id", text: str = "text", gap: int = gap_of(LEAST)) -> DataFrame:
    """Stretches of paragraphs that stand alike in the first document of their components, one row each: LINED_UP.

    The first document is the least by (doc_id, row); `row` is a hash of the text: rows equal in id and text count as
    one document, so repeated rows are no repeats of one another. Null and blank texts have no paragraphs. A null id is
    NO_ID here, the least of all. Successive paragraphs that equal successive ones of the same first document are one
    stretch; a paragraph that is only similar is a stretch of no words at its start: a place to compare from.
    """
    rows = _rows(docs, key, text)
    table = written(paragraph_table(rows, gap), "paragraphs")
    links = written(connected_components(similar_links(rows, table, gap)), "components")
    own = F.xxhash64("doc_id", "row")
    spots = table.groupBy("sig").agg(F.min(own).alias("lo"), F.max(own).alias("hi")).join(links, F.col("sig") == F.col("node"), "left")
    # most paragraphs stand alone: they leave before anything is shuffled again
    spots = written(spots.where("component is not null or lo < hi").select("sig", "component", "lo", "hi"), "spots")
    single = spots.where("component is null and lo < hi").select("sig", F.col("sig").alias("component"))
    linked = spots.where("component is not null").select("sig", "component", "lo", "hi")
    several = linked.groupBy("component").agg(F.min("lo").alias("l"), F.max("hi").alias("h")).where("l < h").select("component")
    shared = written(single.unionByName(linked.join(several, "component", "left_semi").select("sig", "component")), "shared")
    found = written(matched(table.select("doc_id", "row", "number", "start", "words", "sig"), shared, shared.count(), ["sig"]), "found")
    dropped(table, links, spots, shared)
    first = written(found.groupBy("component").agg(F.min(F.struct("doc_id", "row", "number", "start", "words", "sig")).alias("f")), "firsts")
    other = (F.col("doc_id") != F.col("f.doc_id")) | (F.col("row") != F.col("f.row"))
    pairs = found.join(maybe_sent(first, 2 * first.count()), "component").where(other)
    pairs = pairs.select("doc_id", "row", F.col("f.doc_id").alias("first_doc"), F.col("f.row").alias("first_row"), "number", F.col("f.number").alias("first_number"), "start", F.col("f.start").alias("first_start"), "words", F.col("f.words").alias("first_words"), (F.col("sig") == F.col("f.sig")).alias("equal"), "component")

    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, whole = None, None  # the paragraph before, and the stretch that it ends
        for batch in batches:
            out = []
            for x in zip(*(batch[c].tolist() for c in batch.columns)):
                if x == last:
                    continue
                d, r, d1, r1, k, k1, s, s1, n, n1, equal, of = x
                if last and equal and last[10] and last[:4] == x[:4] and (k, k1) == (last[4] + 1, last[5] + 1):
                    whole[6:] = [whole[6] + n, whole[7] + n1, min(whole[8], of)]
                else:
                    if whole:
                        out.append(whole)
                    whole = [d, r, d1, r1, s, s1, *((n, n1) if equal else (0, 0)), of]
                last = x
            yield pd.DataFrame(out, columns=[c.split()[0] for c in LINED_UP.split(", ")])
        if whole:
            yield pd.DataFrame([whole], columns=[c.split()[0] for c in LINED_UP.split(", ")])
        give_back()

    dealt = pairs.repartition("doc_id", "row").sortWithinPartitions("doc_id", "row", "first_doc", "first_row", "number", "first_number")
    out = written(dealt.mapInPandas(stretches, LINED_UP), "stretches")
    dropped(found, first)
    return out


def shared_passages(docs: DataFrame, *, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """doc_id, row, first_doc, first_row, start, first_start, words, first_words, component of every passage of `least`
    words or more that stands in an earlier document as well. Places and lengths are in words."""
    from millrace.llm.passages import extended

    return extended(_rows(docs, key, text), lined_up(docs, key=key, text=text, gap=gap_of(least)), least=least)


def repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """One row per document and passage that an earlier document keeps: doc_id, kind "passage", run (the place of its
    first word), run_words, first_doc, component (the least of its paragraphs' components).

    And one per passage that a document keeps for others: kind "kept", first_doc the document itself.
    """
    spans = shared_passages(docs, key=key, text=text, least=least)
    gone = spans.select("doc_id", F.lit("passage").alias("kind"), F.col("start").alias("run"), F.col("words").alias("run_words"), "first_doc", "component")
    kept = spans.groupBy(F.col("first_doc").alias("doc_id"), "first_row", F.col("first_start").alias("run"), F.col("first_words").alias("run_words")).agg(F.min("component").alias("component"))
    kept = kept.select("doc_id", F.lit("kept").alias("kind"), "run", "run_words", F.col("doc_id").alias("first_doc"), "component")
    return gone.unionByName(kept).withColumns({"doc_id": or_null("doc_id"), "first_doc": or_null("first_doc")})


def without_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", chars: str | None = "n_chars", least: int = LEAST) -> DataFrame:
    """docs whose texts have lost every passage that an earlier document keeps.

    A document of which no word is left goes; documents without words from the start stay. `chars`, if it is a
    column, is counted anew where the text changed.
    """
    spans = shared_passages(docs, key=key, text=text, least=least)
    gone = written(spans.groupBy("doc_id", "row").agg(F.collect_set(F.struct("start", "words")).alias("_spans")), "gone")
    row = F.xxhash64(F.coalesce(F.col(text), F.lit("")))

    @F.pandas_udf("string")
    def shorten(texts: pd.Series, runs: pd.Series) -> pd.Series:
        return pd.Series([without(t, [(x["start"], x["words"]) for x in r]) for t, r in zip(texts, runs)], dtype=object)

    joined = docs.withColumn("_row", row).join(maybe_sent(gone.withColumnsRenamed({"doc_id": "_doc", "row": "_row2"}), 4 * gone.count()), (solid(key) == F.col("_doc")) & (F.col("_row") == F.col("_row2")), "left")
    changed = F.col("_spans").isNotNull()
    fresh = joined.where(changed).withColumn(text, shorten(F.col(text), F.col("_spans")))
    if chars in docs.columns:
        fresh = fresh.withColumn(chars, F.length(text).cast(docs.schema[chars].dataType))
    fresh = fresh.where(F.length(F.trim(F.translate(text, "\t\n\r\x0b\x0c", "     "))) > 0)
    return fresh.select(docs.columns).unionByName(joined.where(~changed).select(docs.columns))
