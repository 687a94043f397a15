"""Time the headline queries: ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.

Prints one JSON line. Each query runs to the end into a no-op sink; ``bpe_train_8000`` is the full
vocabulary job of the tokenizer flow (8,000 tokens, minimum frequency 1).
"""

from __future__ import annotations

import json
import os
import sys
import time

from corpusloom.operators import bpe
from corpusloom.plans.queries import QUERIES, table
from corpusloom.session import build_session

HEADLINE = [
    "scan_jsonl",
    "content_of_lines",
    "hydrate_blobs",
    "join_blob_store",
    "catalog_local_time",
    "qa_fan_out",
    "qa_fan_out_lines",
    "positional_join",
    "positional_join_files",
    "compare_resume",
    "key_profile",
    "corpus_stats",
    "word_counts_topk",
    "term_postings",
    "term_rows",
    "pair_counts",
    "retain_last_n",
    "batch_of_n",
    "py_strip",
    "single_line",
    "collapse_ws",
    "gunzip_decode",
    "pretokenize_words",
    "pretokenize_byte_level",
    "bpe_merges",
    "encode_truncate",
    "encode_bytes",
    "causal_batch",
    "decode_tokens",
    "stream_corpus",
    "stream_tokens",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    wanted = sys.argv[1:] or HEADLINE
    # Start the JVM paths and the Python workers before the clock.
    run(QUERIES["word_counts_topk"](spark, sf_dir))
    run(QUERIES["gunzip_decode"](spark, sf_dir))
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - start, 3)
    if not sys.argv[1:]:
        start = time.perf_counter()
        bpe.bpe_train(table(spark, sf_dir, "documents"), "text", 8000, 1)
        seconds["bpe_train_8000"] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {"metric": "headline_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
