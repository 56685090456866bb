"""The registered queries of the corpus operators: whole tables, production parameters, contract columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, htmltext, hyperminhash, langid, merkle, packing, quality, repeats, rollups, simhash, topk, trie, twins, warc
from millrace.llm.common import id_crc, scratch, written


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_read(spark, sf_dir, "embeddings"))


OP1_SQL = """
WITH whole AS (
    SELECT vec_id AS id, min(list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE)))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    GROUP BY vec_id
), scored AS (
    SELECT q.id AS query_id, r.id AS vec_id, CAST(list_dot_product(q.v, r.v) AS BIGINT) AS score
    FROM whole q JOIN whole r ON q.id <> r.id AND len(q.v) = len(r.v)
    WHERE q.id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return packing.pack(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    held_out = id_crc(F.col("doc_id")) % 3 == 1
    model = langid.fit(docs.where(~held_out))
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats(_read(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all documents, take exact copies back, replace a tokenizer version; commits repeat without effect."""
    counters = {"word_bpe_49k": rollups.bpe_counter(public_tokenizers.path("word_bpe_49k.json")), "words-1": rollups.word_counter, "words-2": rollups.word_counter_2}
    counts = written(rollups.count_tokens(_read(spark, sf_dir, "documents"), counters), "counts")
    first, revised = counts.where("tokenizer <> 'words-2'"), counts.where("tokenizer = 'words-2'")
    ledger = rollups.TokenLedger(spark, scratch(spark, "ledger"))
    ledger.commit("load-1", rollups.signed(first, 1))
    ledger.commit("dedup-1", rollups.signed(rollups.copies(first), -1))
    ledger.commit("load-1", rollups.signed(first, 1))
    gone = rollups.signed(rollups.copies(revised), -1)
    back = rollups.revised(first.where("tokenizer = 'words-1'"), revised)
    kept = rollups.signed(rollups.copies(first.where("tokenizer = 'words-1'")), 1)
    ledger.commit("revise-1", back.unionByName(kept).unionByName(gone))
    return ledger.totals()


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    found = htmltext.extract(pages.select("page_id", "url", "html"), htmltext.fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).try_cast("long")
    second = F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(31_536_000))  # captures in the order of their ids, a second each
    captured = F.date_format(F.timestamp_seconds(second + 1_704_067_200), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    index = warc.archive_index(_read(spark, sf_dir, "pages"), captured=captured)
    return index.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.when(F.col("refers_to").isNotNull(), number("refers_to")).alias("refers_to"), "url_key", "captured", F.col("range").alias("index_range"), F.col("position").alias("index_position"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    held_out = id_crc(F.col("doc_id")) % 4 == 2
    model = quality.fit(docs.where(~held_out), labels.where(~held_out))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents; where 5 divides the crc32 of the id, the text shown has its capitals A-Z in lower case."""
    docs = _read(spark, sf_dir, "documents")
    shown = F.when(id_crc(F.col("doc_id")) % 5 == 0, merkle.without_capitals(F.col("text")))
    found = merkle.manifest(merkle.leaves(docs, tampered=shown))
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all conversations, each with the first turns of the one whose id is the multiple of 5 before."""
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    return trie.prefix_trie(trie.with_shared_heads(trie.turn_lists(_read(spark, sf_dir, "conversations")), group=5, most=8, head=head))


def op13_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_copies(_read(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_top_k, op2_packing, op3_simhash, op4_language_id, op5_repeats, op6_token_counts, op7_decontamination, op8_main_text, op9_warc, op10_quality, op11_merkle, op12_trie, op13_near_copies)}


def oracle_sql() -> dict[str, str]:
    return {"op1_top_k": OP1_SQL, "op11_merkle": twins.OP11, "op12_trie": twins.OP12, "op13_near_copies": twins.OP13}
