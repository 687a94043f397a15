"""One query per operator over its whole table, with the SQL it must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import merkle, minhash, mixing, search
from corpusloom.llm.bpe_codec import round_trip
from corpusloom.llm.exact_dedup import exact_groups
from corpusloom.llm.merkle import tamper_report
from corpusloom.llm.minhash import minhash_classes
from corpusloom.llm.mixing import mixed
from corpusloom.llm.ngram_join import ngram_jaccard
from corpusloom.llm.pii import pii_summary
from corpusloom.llm.folds import held_out
from corpusloom.llm.hnsw import nearest
from corpusloom.llm.langid import languages
from corpusloom.llm.lm_score import cross_entropy_difference
from corpusloom.llm.search import ranked_search
from corpusloom.llm.toxicity import toxicity
from corpusloom.llm.warc import read_warc, write_warc
from corpusloom.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def public_ranks() -> tuple[str, str]:
    """The rank file and the pattern of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = round_trip(table(spark, sf_dir, "documents"), *public_ranks())
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard(table(spark, sf_dir, "documents"), width=4, num=85, den=100)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op4_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"), numbered=True).select("doc_id", "source", "text", "copy", "shuffle_key")


def op5_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, F.col("vec_id") % 50 == 0, k=5)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_summary(table(spark, sf_dir, "documents"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return cross_entropy_difference(table(spark, sf_dir, "documents"), target)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    return toxicity(docs, labels).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity_score").alias("score"),
        (F.col("toxicity_score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tamper_report(table(spark, sf_dir, "documents"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_classes(table(spark, sf_dir, "documents"), width=3, num=85, den=100)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_poisson_mixing": op4_poisson_mixing,
    "op5_hnsw": op5_hnsw,
    "op6_pii": op6_pii,
    "op7_lm_score": op7_lm_score,
    "op8_toxicity": op8_toxicity,
    "op9_langid": op9_langid,
    "op10_warc": op10_warc,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_minhash": op12_minhash,
    "op13_ranked_search": op13_ranked_search,
}

ORACLES: dict[str, str] = {
    "op3_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
          doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op4_poisson_mixing": mixing.ORACLE,
    "op10_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS bytes FROM pages),
        f AS (SELECT page_id, html, bytes, min(page_id) OVER (PARTITION BY html) AS first FROM p)
        SELECT page_id, bytes AS payload_bytes, sha256(html) AS payload_digest,
          CASE WHEN bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
          CASE WHEN bytes >= 100 AND page_id > first THEN first END AS refers_to
        FROM f
    """,
    "op11_merkle_manifest": merkle.ORACLE,
    "op12_minhash": minhash.ORACLE,
    "op13_ranked_search": search.ORACLE,
}
