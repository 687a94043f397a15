"""The three end-to-end flows, as compositions of the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import single_line
from corpusloom.operators.bpe import BpeModel, bpe_train, load_tokenizer, save_tokenizer
from corpusloom.operators.records import content_of_lines, drop_empty_blob, rewrite_lines
from corpusloom.operators.tokens import MAX_LENGTH, encode
from corpusloom.session import written
from corpusloom.sources.blobs import hydrate_blobs, join_blob_store, scan_blob_store
from corpusloom.sources.files import scan_jsonl, scan_lines, scan_manifest
from corpusloom.sources.sinks import output_exists, split_dead_letter, write_jsonl, write_lines, write_text


def _write_corpus(hydrated: DataFrame, out: str, as_text: bool, mode: str) -> None:
    good, _ = split_dead_letter(hydrated, "error")
    if as_text:
        lines = drop_empty_blob(good.select(single_line(F.col("content")).alias("content")))
        write_text(lines, "content", out, mode)
    else:
        write_jsonl(drop_empty_blob(good.select("content")), out, mode=mode)


def manifest_to_corpus(
    spark: SparkSession,
    manifest_dir: str,
    out: str,
    fetcher: Callable[[str], bytes] | None = None,
    store: str | None = None,
    as_text: bool = False,
    dead_letters: str | None = None,
    mode: str = "errorifexists",
    **fetch_options,
) -> dict[str, int]:
    """Manifests to one corpus, from a fetcher or from a blob store; returns ``rows`` and ``failed``.

    The hydrated rows are written once when failures are kept too, so that no blob is fetched twice.
    """
    ids = scan_manifest(spark, manifest_dir)
    if fetcher is not None:
        rows = hydrate_blobs(ids, fetcher, **fetch_options)
    else:
        rows = join_blob_store(ids, scan_blob_store(spark, store))
    seen = Observation()
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count("error").alias("failed"))
    if dead_letters is not None:
        rows = written(rows, "hydrated")
        split_dead_letter(rows, "error")[1].select("blob_id", "error").write.mode(mode).parquet(dead_letters)
    _write_corpus(rows, out, as_text, mode)
    return seen.get


def corpus_to_tokens(
    spark: SparkSession,
    corpus: str,
    tokenizer_dir: str,
    out: str,
    vocab_size: int = 8000,
    min_frequency: int = 1,
    max_length: int = MAX_LENGTH,
    **train_options,
) -> BpeModel:
    """JSON-line corpus to a tokenizer and token rows; a stage whose output exists is skipped."""
    texts = content_of_lines(scan_jsonl(spark, corpus, nan=False))
    if output_exists(spark, f"{tokenizer_dir}/options"):
        model = load_tokenizer(spark, tokenizer_dir)
    else:
        model = bpe_train(texts, "content", vocab_size, min_frequency, **train_options)
        save_tokenizer(model, spark, tokenizer_dir, mode="overwrite")
    if not output_exists(spark, out):
        rows = encode(texts, "content", model, max_length).select("input_ids")
        write_jsonl(rows, out, mode="overwrite")
    return model


def repair_records(
    spark: SparkSession, path: str, out: str, dead_letters: str | None = None, fan_out: bool = True
) -> dict[str, int]:
    """Question/answer lines to content lines in their order; returns ``rows`` and ``failed``.

    Unusable lines go to their own output if there is one.
    """
    lines = rewrite_lines(scan_lines(spark, path), "raw", fan_out)
    seen = Observation()
    lines = lines.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("lines").isNull(), 1)).alias("failed"))
    if dead_letters is not None:
        lines = written(lines, "rewritten")
        write_lines(lines.where(F.col("lines").isNull()), dead_letters, mode="overwrite")
    write_lines(lines.select(F.explode("lines").alias("raw")), out, mode="overwrite")
    return seen.get
