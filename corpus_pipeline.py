"""A training-data pipeline over ``documents``: each stage works on what the one before has kept.

Toxic documents go, equal texts become one, of near copies the one with the smallest id stays, sources
are mixed to their target weights, and every document that is left gets its token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.bpe_codec import encoded, n_tokens
from corpusloom.llm.exact_dedup import exact_dedup
from corpusloom.llm.mixing import mixed
from corpusloom.llm.ngram_join import ngram_jaccard
from corpusloom.llm.queries import public_ranks
from corpusloom.llm.toxicity import toxicity
from corpusloom.session import small_batches, written

# A document with this score or more is rejected.
TOXIC = 0.5


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not toxic; the score is learned from ``labels``."""
    scored = toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where(F.col("toxicity_score") < TOXIC).select(*docs.columns)


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies (shingles of five words, similarity 0.8) the document with the smallest id."""
    classes = ngram_jaccard(docs)
    dropped = written(classes.where("component_id <> doc_id").select("doc_id").distinct(), "near-copies")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents repeated and shuffled so that sources meet their target weights."""
    return mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``n_tokens`` and ``token_ids`` (little-endian unsigned 32-bit integers)."""
    small_batches(spark)
    coded = docs.withColumn("token_ids", encoded(F.col("text"), *public_ranks()))
    return coded.withColumn("n_tokens", n_tokens(F.col("token_ids")))


STAGES = [
    ("toxicity", remove_toxic),
    ("exact dedup", remove_copies),
    ("n-gram Jaccard join", remove_near_copies),
    ("mixing", mix_sources),
    ("byte-level BPE", tokenize),
]

# The toxicity stage has no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
