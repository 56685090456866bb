"""Token counts: totals by source, language and tokenizer version, kept up to date by signed deltas.

Counting a text costs; adding counts does not. Documents are counted once per tokenizer version; inserts, deletes and
revised counts become rows with a sign, summed up per key before they are committed, and the totals are the sum of
all committed batches. A batch id is committed once: committing it again changes nothing, so a job that is run anew
after a failure may repeat all its commits.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import give_back, or_null, small_batches, solid
from millrace.llm.packing import _coder

KEYS = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, documents long, tokens long"
WORD = re.compile(r"\w+")


def bpe_counter(path: str) -> Callable[[str], int]:
    """Tokens of a text by a tokenizer file, without special tokens."""
    return lambda text: len(_coder(path).ids(text)) // 4


def word_counter(text: str) -> int:
    """Runs without ASCII blanks."""
    return len(text.encode("utf-8", "surrogatepass").split())


def word_counter_2(text: str) -> int:
    """Revised: runs of letters, digits and underscores."""
    return len(WORD.findall(text))


def count_tokens(docs: DataFrame, counters: dict[str, Callable[[str], int]], *, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """doc_id, source, lang, tokenizer, n_tokens, digest: a row per document and tokenizer version, over the whole text.

    digest is the SHA-256 of the text. Null text counts as empty; null sources and languages are keys like any other;
    repeated rows count each.
    """
    names = sorted(counters)
    small_batches(docs.sparkSession)

    @F.pandas_udf("array<long>")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series([[counters[n](t or "") for n in names] for t in part], dtype=object)
        give_back()

    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(solid(key).alias("doc_id"), F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang"), F.sha2(whole, 256).alias("digest"), count(F.col(text)).alias("_n"))
    pairs = F.array(*[F.struct(F.lit(n).alias("tokenizer"), F.col("_n")[i].alias("n_tokens")) for i, n in enumerate(names)])
    return rows.select(or_null("doc_id").alias("doc_id"), "source", "lang", "digest", F.inline(pairs))


def signed(counts: DataFrame, sign: int) -> DataFrame:
    """Inserts (+1) or deletes (-1) as deltas."""
    return counts.select(*KEYS, F.lit(sign).cast("long").alias("documents"), (F.coalesce("n_tokens", F.lit(0)) * sign).cast("long").alias("tokens"))


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    """Deltas that take the old counts back and put the new ones in."""
    return signed(old, -1).unionByName(signed(new, 1))


def copies(counts: DataFrame) -> DataFrame:
    """The counts of documents whose text an earlier document (by id; nulls last) holds, for deletion.

    Of rows with equal text and id all but none are earlier: they stay together. The first id is found by a
    combined aggregate, so a text that a third of all rows share is one row there.
    """
    first = counts.groupBy("digest").agg(F.min("doc_id").alias("_first"))
    return counts.join(first, "digest").where(F.col("_first").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("_first")))).drop("_first")


class TokenLedger:
    """Committed batches below one folder, a sub-folder each; any store that Spark reaches will do."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, batch: str, *more: str):
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"batch ids are letters, digits, dots and dashes: {batch!r}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, f"batch={batch}", *more)))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def committed(self, batch: str) -> bool:
        """Whether the batch has been written to its end (Spark's mark of success)."""
        files, mark = self._at(batch, "_SUCCESS")
        return bool(files.exists(mark))

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Sum deltas up by key and commit them under the id; False, and no change, if the id is committed already.

        What an attempt that failed has left under the id is written over.
        """
        if self.committed(batch):
            return False
        summed = deltas.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).where("documents <> 0 or tokens <> 0")
        summed.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(f"{self.path}/batch={batch}")
        return True

    def batches(self) -> list[str]:
        files, root = self._at("x")
        root = root.getParent()
        found = [s.getPath().getName().removeprefix("batch=") for s in files.listStatus(root)] if files.exists(root) else []
        return sorted(b for b in found if self.committed(b))

    def totals(self) -> DataFrame:
        """The sum of all committed batches; keys without documents and tokens are left out."""
        paths = [f"{self.path}/batch={b}" for b in self.batches()]
        if not paths:
            return self.spark.createDataFrame([], SCHEMA)
        parts = [self.spark.read.schema(SCHEMA).parquet(p) for p in paths]
        return reduce(DataFrame.unionAll, parts).groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).where("documents <> 0 or tokens <> 0")
