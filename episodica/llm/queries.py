"""The corpus queries: each applies one operator, with its production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.llm import bpe, exact, html, langid, licenses, lm, mixing, pii, simhash, vectors
from episodica.llm.common import materialize, read_table
from episodica.llm.stages import BPE_VOCABULARY

def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best inner products for each vector whose id is divisible by 100, the stated query set, against all rows."""
    table = read_table(spark, sf_dir, "embeddings")
    return vectors.top_k(table, table.filter(F.col("vec_id") % 100 == 0), k=10, scale=1024)


OP1_SQL = """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as e from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
    select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::bigint as score
    from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0
), r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::integer as rank, vec_id, score from r where rank <= 10
"""


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page."""
    return html.extract(read_table(spark, sf_dir, "pages"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    return bpe_digests(bpe.encode(read_table(spark, sf_dir, "documents"), BPE_VOCABULARY, public_tokenizers.PATTERN, decoded=True))


def bpe_digests(decoded: DataFrame) -> DataFrame:
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and statements of every document."""
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs.select("doc_id", "text"), langid.fit(docs))
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and neural log10 probabilities of every document."""
    return lm.score(read_table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of equal texts and the document of it that stays."""
    return exact.deduplicate(read_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP7_SQL = """
with d as (
    select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256
    from documents
)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept, text_sha256
from d window w as (partition by text_sha256)
"""


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, spans and their digest for every document."""
    return pii.digest(pii.find(read_table(spark, sf_dir, "documents")))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's raked weight, probability and draw."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    found = mixing.mix(materialize(mixing.measure(docs).drop("text"), "measured"))
    return found.select("doc_id", "source", "lang", "topic", "tokens", "weight", "probability", "sampled")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint and component_id of every document, linked at 2 or fewer differing bits of 64."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), width=3, max_bits=2, rotations=3)
    return found.select("doc_id", simhash.hex16("fp").alias("fingerprint"), "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk": op1_topk,
    "op2_html": op2_html,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_licenses": op4_licenses,
    "op5_language": op5_language,
    "op6_lm_score": op6_lm_score,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_pii": op8_pii,
    "op9_mixing": op9_mixing,
    "op10_simhash": op10_simhash,
    "pipeline": pipeline,
}
ORACLES: dict[str, str] = {"op1_topk": OP1_SQL, "op4_licenses": licenses.oracle_sql(), "op7_exact_dedup": OP7_SQL, "op9_mixing": mixing.oracle_sql()}
