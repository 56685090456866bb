"""Language identification with bit-sliced Bloom filters over character n-grams.

Every slot of the filter holds one bit per language. Looking an n-gram up means reading K slots and
taking the bitwise AND: the set of all languages that contain the n-gram, in one go. A text adds up the
sets of its n-grams per language (popcounts by bit); what each language would get from false
positives alone, its fill rate to the power K, is taken out, and the largest share decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import give_back, hash_cut, mixed, slices, small_batches

ORDERS = (3, 4)
UNKNOWN = "und"
PIECE = 1 << 19  # characters of one text worked on at a time
GROUP = 1 << 17  # and of several texts: what is held at once is about a hundred times that, in bytes


@dataclass
class LanguageFilters:
    languages: list[str]
    slots: np.ndarray  # uint64 masks, shape (2**bits, words): bit j of word i is language 64*i+j
    bits: int
    hashes: int
    orders: tuple[int, ...]

    @property
    def false_rate(self) -> np.ndarray:
        """Per language, the chance that an n-gram it lacks is found all the same."""
        fill = [float(np.mean((self.slots[:, j // 64] >> np.uint64(j % 64)) & np.uint64(1))) for j in range(len(self.languages))]
        return np.array(fill) ** self.hashes


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)], dtype=bool)


def grams(texts: list[str], orders: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of each text and the index of the text they belong to.

    Texts are lower-cased; each run of other characters counts as one space; an n-gram holds two letters at least.
    """
    parts = [f" {t} ".lower() for t in texts]
    code = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    letter = _letters()[code]
    keep = letter.copy()
    keep[1:] |= letter[:-1] | (owner[1:] != owner[:-1])  # the first of a run of other characters stays, as a space
    keep[0] = True
    code, owner, letter = np.where(letter, code, 32)[keep].astype(np.uint64), owner[keep], letter[keep].astype(np.int8)
    hashes, owners = [], []
    for n in orders:
        size = len(code) - n + 1
        if size < 1:
            continue
        h, held = np.full(size, n, dtype=np.uint64), np.zeros(size, dtype=np.int8)
        for k in range(n):
            with np.errstate(over="ignore"):
                h = h * np.uint64(0x100000001B3) + code[k : k + size]
            held += letter[k : k + size]
        good = (held >= 2) & (owner[:size] == owner[n - 1 :])
        hashes.append(mixed(h[good]))
        owners.append(owner[:size][good])
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


def _pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Groups of texts of GROUP characters; a text longer than PIECE comes in pieces that overlap by what an n-gram needs."""
    whole = [t or "" for t in texts]
    for a, b in slices([len(t) for t in whole], GROUP):
        if b - a > 1 or len(whole[a]) <= PIECE:
            yield list(range(a, b)), whole[a:b]
        else:
            for k in range(0, len(whole[a]), PIECE):
                yield [a], [whole[a][k : k + PIECE + max(ORDERS) - 1]]


def slot_numbers(h: np.ndarray, bits: int, hashes: int) -> list[np.ndarray]:
    return [(mixed(h, k + 1) >> np.uint64(64 - bits)).astype(np.int64) for k in range(hashes)]


def fit(docs: DataFrame, *, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = 3000, least: int = 3, share: float = 0.12, bits: int = 20, hashes: int = 2, orders: tuple[int, ...] = ORDERS) -> LanguageFilters:
    """Learn the filters from the rows of docs that name a language.

    Trained on about per_language rows of each language, chosen by a hash of key: the bound on the sample.
    An n-gram goes into a language's filter if the sample has it `least` times there and its rate is `share` of its
    highest rate in any language (foreign quotations would else fill every filter). The filter has 2**bits slots.
    Without labelled rows, the model knows no language and answers "und".
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(key).alias("key"), F.col(text).alias("text"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(counts)
    if not names:
        return LanguageFilters([], np.zeros((1 << bits, 1), np.uint64), bits, hashes, orders)
    # one scan: a row is taken if its hash is below its language's cut
    cuts = F.create_map(*[F.lit(x) for n in names for x in (n, hash_cut(counts[n], per_language))])
    picked = rows.where(F.xxhash64("key", F.lit("sample")) <= cuts[F.col("lang")])
    got = {r["lang"]: r["n"] for r in picked.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    odd = [n for n in names if not 0 < got.get(n, 0) <= 2 * per_language + 100]  # too many rows share a key there
    if odd:
        picked = picked.where(~F.col("lang").isin(odd))
        for name in odd:
            picked = picked.unionAll(rows.where(F.col("lang") == name).limit(per_language))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, own in batch.groupby("lang", sort=False):
                for _, texts in _pieces(own["text"].tolist()):
                    h, n = np.unique(grams(texts, orders)[0], return_counts=True)
                    yield pd.DataFrame({"lang": name, "gram": h.view(np.int64), "n": n})
        give_back()

    found = picked.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    index = F.create_map(*[F.lit(x) for pair in ((n, i) for i, n in enumerate(names)) for x in pair])
    table = found.withColumn("j", index[F.col("lang")]).select("gram", "j", "n").toArrow()
    gram, j, n = (table.column(c).to_numpy() for c in ("gram", "j", "n"))
    rate = n / np.maximum(1, np.bincount(j, n, len(names)))[j]
    order = np.argsort(gram, kind="stable")
    gram, j, n, rate = gram[order], j[order], n[order], rate[order]
    starts = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]]) if len(gram) else np.empty(0, np.int64)
    top = np.repeat(np.maximum.reduceat(rate, starts), np.diff(np.r_[starts, len(gram)])) if len(gram) else rate
    good = (n >= least) & (rate >= share * top)
    slots = np.zeros((1 << bits, (len(names) + 63) // 64), np.uint64)
    for at in slot_numbers(gram[good].view(np.uint64), bits, hashes):
        for i in range(slots.shape[1]):
            here = j[good] // 64 == i
            np.bitwise_or.at(slots[:, i], at[here], np.uint64(1) << (j[good][here] % 64).astype(np.uint64))
    return LanguageFilters(names, slots, bits, hashes, orders)


def score_texts(model: LanguageFilters, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The language of every text and how much of the evidence it has, from 0 to 1."""
    size = len(model.languages)
    hits, total = np.zeros((len(texts), max(1, size))), np.zeros(len(texts))
    for rows, part in _pieces(texts):
        h, owner = grams(part, model.orders)
        masks = None
        for at in slot_numbers(h, model.bits, model.hashes):
            masks = model.slots[at] if masks is None else masks & model.slots[at]
        total[rows] += np.bincount(owner, minlength=len(part))
        for j in range(size):
            hits[rows, j] += np.bincount(owner, (masks[:, j // 64] >> np.uint64(j % 64)) & np.uint64(1), len(part))
    if not size:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    false = model.false_rate
    share = np.clip((hits / np.maximum(total, 1)[:, None] - false) / np.maximum(1 - false, 1e-9), 0, 1)
    best = share.argmax(axis=1)
    lettered = np.array([any(map(str.isalpha, t or "")) for t in texts], dtype=bool)
    score = np.where(lettered, share.max(axis=1) / np.maximum(share.sum(axis=1), 1e-9), 0.0)
    return [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)], np.clip(score, 0, 1)


def identify(docs: DataFrame, model: LanguageFilters, *, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """docs with the predicted language and its score; columns of those names are replaced.

    Null text, and text without a letter, is "und" with score 0. A text with letters but without a known n-gram gets
    the first language with score 0. Repeated rows each get their answer; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shipped = spark.sparkContext.broadcast(model)  # 2**bits slots at most, whatever the corpus
    kept = docs.drop(lang, score)

    @F.pandas_udf("lang string, score double")
    def answer(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            names, scores = score_texts(shipped.value, part.tolist())
            yield pd.DataFrame({"lang": names, "score": scores})
        give_back()

    return kept.withColumn("_answer", answer(F.col(text))).select(*[kept[c] for c in kept.columns], F.col("_answer.lang").alias(lang), F.col("_answer.score").alias(score))
