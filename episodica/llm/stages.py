"""The stages of the corpus pipeline: each takes (spark, docs, sf_dir) and works on all rows of docs."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.llm import bpe, exact, langid, mixing, simhash
from episodica.llm.common import materialize, text_or_empty

BPE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Near copies: five words, and a Jaccard similarity of 0.8 or more.
NEAR_DUPLICATES = {"width": 5, "similarity": 0.8}
#: Rows that are dropped by a broadcast (some 60 bytes each) instead of a shuffle of all texts.
BROADCAST_ROWS = 250_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified with calibrated confidence."""
    return langid.identify(docs, langid.fit(docs)).filter(~F.col("rejected")).select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the row with the largest doc_id; of rows that repeat it, one."""
    return exact.staying(docs, exact.deduplicate(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that with the smallest doc_id, of each group of near copies. Rows are told apart by id and text."""
    found = materialize(simhash.near_duplicates(docs, **NEAR_DUPLICATES).select("doc_id", "text_hash", "kept"), "near")
    key = ["doc_id", "text_hash"]
    kept = found.filter("kept").select(*(F.col(c).alias(f"__{c}") for c in key))
    gone = found.filter("not kept").select(*key)
    gone = materialize(gone.join(kept, gone["doc_id"].eqNullSafe(kept["__doc_id"]) & (gone["text_hash"] == kept["__text_hash"]), "left_anti").distinct(), "gone")
    gone = gone.select(*(F.col(c).alias(f"__{c}") for c in key))
    rows = docs.withColumn("__text", F.xxhash64(text_or_empty()))
    same = rows["doc_id"].eqNullSafe(gone["__doc_id"]) & (rows["__text"] == gone["__text_hash"])
    return rows.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, same, "left_anti").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents whose tokens have the target marginals."""
    return mixing.mix(mixing.measure(docs)).filter("sampled").select(docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (packed 32-bit), and digests of them and of what they decode to."""
    found = bpe.encode(docs, BPE_VOCABULARY, public_tokenizers.PATTERN, decoded=True)
    return found.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
