"""One query per operator over the driver tables.

Each takes ``(spark, sf_dir)`` and runs over whole tables. Where an operator reads files, Spark first
writes them from a table into the shared folder.
"""

from __future__ import annotations

import gzip
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from corpusloom.functions import blobs as fblobs
from corpusloom.functions import text as ftext
from corpusloom.functions.clock import format_stamp, parse_stamp
from corpusloom.functions.jsontext import string_field, to_json_line, with_parsed
from corpusloom.functions.words import pretokenize_bytes, pretokenize_ws, to_byte_text
from corpusloom.operators import bpe, mapping, piece_codec, piece_files, pieces, positions, profile, records, runlog, tokens
from corpusloom.session import scratch_path, spread, written
from corpusloom.sources import blobs, catalog, files, sinks
from corpusloom.streaming.intake import incremental_corpus, incremental_dead_letters

VOCAB_SIZE = 300
PIECE_VOCAB_SIZE = 480
PAD_ID = 1
PADDED_LENGTH = 2048
# Whitespace that plain trimming leaves: no-break space, em space, file and unit separator, wide space.
PAD_LEFT = " \t" + chr(0xA0) + chr(0x2003)
PAD_RIGHT = chr(0x1C) + chr(0x1F) + chr(0x3000) + " \r\n"
# A source whose JSON lines the queries cut short, to have malformed lines to report.
BROKEN_SOURCE = "src3"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """The text table, spread over the cores when it is small."""
    return spread(table(spark, sf_dir, "documents").select(*cols))


def utc_text(col: Column) -> Column:
    """A time stamp as text; the result does not depend on the session time zone."""
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


@F.pandas_udf(BinaryType())
def _gzipped(data: pd.Series) -> pd.Series:
    return data.map(lambda d: None if d is None else gzip.compress(bytes(d), 1))


def text_bytes(col: Column) -> Column:
    return F.encode(col, "UTF-8")


_models: dict[tuple[str, str, str], bpe.BpeModel] = {}


def trained(spark: SparkSession, sf_dir: str, words: str = "ws") -> bpe.BpeModel:
    """The vocabulary of the documents, learned once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, words)
    if key not in _models:
        docs = table(spark, sf_dir, "documents")
        _models[key] = bpe.bpe_train(docs, "text", VOCAB_SIZE, 2, words=words)
    return _models[key]


def digest(col: Column) -> Column:
    """A list as one comparable value."""
    return F.md5(F.array_join(col, " "))


# --- scans and sources


def _document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON lines, those of one source cut short."""
    docs = documents(spark, sf_dir, "doc_id", "text", "source")
    line = to_json_line(F.col("doc_id"), F.col("text").alias("content"))
    cut = F.substr(line, F.lit(1), F.length(line) - 1)
    return docs.select(F.when(F.col("source") == BROKEN_SOURCE, cut).otherwise(line).alias("raw"))


def _written_lines(spark: SparkSession, sf_dir: str, label: str) -> str:
    path = scratch_path(spark, label)
    sinks.write_lines(_document_lines(spark, sf_dir), path)
    return path


@query
def scan_jsonl(spark, sf_dir):
    scan = files.scan_jsonl(spark, _written_lines(spark, sf_dir, "scan-jsonl"))
    return scan.select(
        F.try_variant_get("parsed", "$.doc_id", "bigint").alias("doc_id"),
        string_field(F.col("parsed"), "content").alias("content"),
        "is_valid",
    )


@query
def scan_jsonl_typed(spark, sf_dir):
    path = _written_lines(spark, sf_dir, "scan-typed")
    scan = files.scan_jsonl(spark, path, "doc_id bigint, content string")
    return scan.where("is_valid").select("parsed.*")


@query
def scan_manifest(spark, sf_dir):
    path = scratch_path(spark, "manifest")
    docs = table(spark, sf_dir, "documents")
    blob_id = F.md5(F.col("doc_id").cast("string")).alias("blob_id")
    docs.select(blob_id, F.col("lang").alias("src_encoding")).write.parquet(path)
    return files.scan_manifest(spark, path)


@query
def list_inputs(spark, sf_dir):
    path = scratch_path(spark, "listing")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    docs.write.partitionBy("source").parquet(path)
    found = files.list_inputs(spark, f"{path}/*", "part-", ".parquet")
    return found.select(F.regexp_extract("path", "source=([^/]+)", 1).alias("source")).distinct()


@query
def path_predicate(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.where(ftext.match_path(F.col("url"), "https://", ".html")).orderBy("url", "page_id")


@query
def scan_csv_text(spark, sf_dir):
    """Whole texts, most of them with line breaks, written as CSV cells and read back."""
    path = scratch_path(spark, "csv-text")
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return files.scan_csv(spark, path, "doc_id bigint, text string")


@query
def scan_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    table(spark, sf_dir, "labels").write.option("header", True).csv(path)
    return files.scan_csv(spark, path).select(*[F.col(c).cast("bigint").alias(c) for c in ("doc_id", "quality", "toxic")])


@query
def scan_tokens(spark, sf_dir):
    path = scratch_path(spark, "tokens")
    docs = documents(spark, sf_dir, "text")
    sinks.write_jsonl(docs.select(F.transform(pretokenize_ws(F.col("text")), F.length).alias("input_ids")), path)
    rows = files.scan_tokens(spark, path)
    return rows.select(F.size("input_ids").cast("bigint").alias("n_ids"), digest(F.col("input_ids")).alias("ids"))


def _page_server():
    """Stands in for a remote store: some pages are gone, some need a third try."""
    tries: dict[str, int] = {}

    def fetch(blob_id: str) -> bytes:
        tries[blob_id] = tries.get(blob_id, 0) + 1
        if "casino" in blob_id:
            raise FileNotFoundError("gone")
        if "page=" in blob_id and tries[blob_id] < 3:
            raise TimeoutError("busy")
        return gzip.compress(b"\xff <" + blob_id.encode("utf-8") + b">\n")

    return fetch


@query
def hydrate_blobs(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    manifest = pages.select(F.concat_ws("|", "page_id", "url").alias("blob_id"))
    rows = blobs.hydrate_blobs(
        manifest, _page_server(), max_retries=4, partitions=spark.sparkContext.defaultParallelism, sleep=lambda s: None
    )
    return rows.select(
        "blob_id",
        ftext.py_strip(F.col("content")).alias("content"),
        F.col("attempts").cast("bigint").alias("attempts"),
        "error",
    )


@query
def hydrate_resumable(spark, sf_dir):
    """Every page from its packed body: a first run has the pages with a query string, the next one all that are left."""
    packed = F.base64(_gzipped(text_bytes(F.coalesce("html", F.lit("")))))
    body = F.concat(F.lit("data:application/gzip;base64,"), F.regexp_replace(packed, r"\s", ""))
    host = F.regexp_extract("url", "^[a-z]+://([^/]+)", 1)
    pages = written(table(spark, sf_dir, "pages").select("page_id", "url", host.alias("host"), body.alias("blob_id")), "packed-pages")
    ledger = scratch_path(spark, "fetched-pages")
    how = {"ids_per_block": 20_000, "host": "host", "per_second": 10_000.0}
    blobs.hydrate_resumable(pages.where(F.contains("url", F.lit("?"))), blobs.url_fetcher("{}"), ledger, **how)
    rows = blobs.hydrate_resumable(pages, blobs.url_fetcher("{}"), ledger, **how)
    found = rows.withColumn("key", F.sha2("blob_id", 256)).drop("blob_id")
    keyed = pages.select("page_id", F.sha2("blob_id", 256).alias("key"))
    return keyed.join(found, "key", "left").select("page_id", "content", F.col("attempts").cast("bigint").alias("attempts"), "error")


def _blob_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All documents as the manifest; the labelled ones, once per content, as the store."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.md5(text_bytes(F.col("text"))).alias("blob_id")
    )
    labels = table(spark, sf_dir, "labels").select("doc_id")
    store = docs.join(labels, "doc_id", "left_semi").dropDuplicates(["blob_id"])
    return docs.select("doc_id", "blob_id"), store.select(
        "blob_id", _gzipped(text_bytes(F.col("text"))).alias("data")
    )


@query
def corpus_files(spark, sf_dir):
    """Bytes and lines of the files of a corpus, summed by the folder of their source."""
    path = scratch_path(spark, "corpus-files")
    lines = documents(spark, sf_dir, "source", "text").select("source", ftext.single_line(F.col("text")).alias("value"))
    lines.repartition("source").write.partitionBy("source").text(path)
    source = F.regexp_extract("path", "/source=([^/]+)/", 1).alias("source")
    return files.input_stats(spark, path).groupBy(source).agg(F.sum("n_bytes").alias("n_bytes"), F.sum("n_lines").alias("n_lines"))


@query
def join_blob_store(spark, sf_dir):
    manifest, store = _blob_tables(spark, sf_dir)
    return blobs.join_blob_store(manifest, store).select("doc_id", "content", "error")


@query
def manifest_to_corpus(spark, sf_dir):
    manifest, store = _blob_tables(spark, sf_dir)
    good, _ = sinks.split_dead_letter(blobs.join_blob_store(manifest, store), "error")
    path = scratch_path(spark, "corpus")
    sinks.write_jsonl(records.drop_empty_blob(good.select("content")), path)
    return spark.read.schema("content string").json(path)


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    return table(spark, sf_dir, "events").select(
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("id"),
        F.col("event_type").alias("name"),
        F.when(F.col("event_type") == "error", "unknown")
        .when(F.col("event_type") != "signup", stamp)
        .alias("modifiedTime"),
        F.when(F.col("event_type") != "click", F.col("event_type") == "view").alias("shared"),
    )


@query
def list_catalog(spark, sf_dir):
    return catalog.list_catalog(_listing(spark, sf_dir), shared_only=True, page_size=100)


@query
def catalog_local_time(spark, sf_dir):
    return catalog.list_catalog(_listing(spark, sf_dir), page_size=None)


# --- sinks


@query
def write_jsonl(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    sinks.write_jsonl(table(spark, sf_dir, "conversations"), path, max_rows=1000)
    return spark.read.schema("conv_id bigint, turn bigint, role string, text string").json(path)


@query
def write_text(spark, sf_dir):
    path = scratch_path(spark, "text")
    docs = documents(spark, sf_dir, "text")
    sinks.write_text(docs.select(ftext.single_line(F.col("text")).alias("line")), "line", path)
    return files.scan_text_corpus(spark, path)


@query
def write_modes(spark, sf_dir):
    path = scratch_path(spark, "modes")
    sinks.write_jsonl(table(spark, sf_dir, "conversations").select("text"), path)
    sinks.write_jsonl(table(spark, sf_dir, "benchmark").select("text"), path, mode="overwrite")
    sinks.write_jsonl(table(spark, sf_dir, "documents").select("text"), path, mode="ignore")
    return spark.read.schema("text string").json(path)


@query
def save_load_tokenizer(spark, sf_dir):
    path = scratch_path(spark, "tokenizer")
    bpe.save_tokenizer(trained(spark, sf_dir), spark, path)
    loaded = bpe.load_tokenizer(spark, path)
    return loaded.merge_table(spark).select(
        *[F.col(c).cast("bigint").alias(c) for c in ("rank", "left_id", "right_id", "id")]
    )


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("run-"), F.col("user_id")).alias("run_id"),
        F.col("event_id").alias("step"),
        (F.col("event_id") / 1000).alias("epoch"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("loss"),
        F.col("ts"),
        F.col("event_type").alias("model_path"),
    )


@query
def append_run_state(spark, sf_dir):
    path = scratch_path(spark, "run-state")
    states = _states(spark, sf_dir)
    for kind in ("view", "click", "signup", "error", "purchase"):
        sinks.append_run_state(states.where(F.col("model_path") == kind), path)
    stored = files.scan_run_states(spark, path)
    return stored.select("run_id", "step", "loss", utc_text(F.col("ts")).alias("ts"), "model_path")


@query
def dead_letters(spark, sf_dir):
    scan = with_parsed(_document_lines(spark, sf_dir))
    _, bad = sinks.split_dead_letter(scan)
    return bad.select("raw")


# --- projections, filters, predicates


@query
def filter_valid_json(spark, sf_dir):
    rows = records.filter_valid_json(_document_lines(spark, sf_dir))
    return rows.select(F.get_json_object("raw", "$.doc_id").cast("bigint").alias("doc_id"))


@query
def filter_content(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    blank = F.concat(F.lit(PAD_LEFT), F.regexp_replace("text", r"[^ \n]", ""), F.lit(PAD_RIGHT))
    content = F.when(F.col("role") == "user", blank).otherwise(F.col("text"))
    return records.filter_content(turns.select("conv_id", "turn", content.alias("content")))


@query
def content_of_lines(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    text_line = to_json_line(F.col("conv_id"), F.col("text").alias("content"))
    number_line = to_json_line(F.col("conv_id"), F.col("turn").alias("content"))
    lines = turns.select(F.when(F.col("role") == "user", number_line).otherwise(text_line).alias("raw"))
    return records.content_of_lines(with_parsed(lines))


@query
def drop_empty_blob(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    padded = F.concat(F.lit(PAD_LEFT), F.col("text"), F.lit(PAD_RIGHT))
    content = F.when(F.col("lang") == "de", F.lit(PAD_LEFT + PAD_RIGHT)).when(F.col("lang") != "fr", padded)
    return records.drop_empty_blob(docs.select("doc_id", content.alias("content")))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question and answer turns, and single texts, as records of one open table."""
    turns = table(spark, sf_dir, "conversations")
    answers = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    pairs = asked.join(answers, ["conv_id", "turn"], "left")
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id"), F.col("text").alias("content"))
    return records.union_corpora(pairs, items)


@query
def qa_inline(spark, sf_dir):
    return records.qa_inline(_pairs(spark, sf_dir))


@query
def qa_fan_out(spark, sf_dir):
    return records.qa_fan_out(_pairs(spark, sf_dir))


def _pair_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select(F.to_json(F.struct("*")).alias("raw"))


def _line_fields(rows: DataFrame) -> DataFrame:
    fields = "conv_id bigint, turn bigint, item_id bigint, question string, response string, content string"
    return rows.select(F.from_json("raw", fields).alias("r")).select("r.*")


@query
def qa_inline_lines(spark, sf_dir):
    return _line_fields(records.qa_inline_lines(_pair_lines(spark, sf_dir)))


@query
def qa_fan_out_lines(spark, sf_dir):
    return _line_fields(records.qa_fan_out_lines(_pair_lines(spark, sf_dir)))


@query
def drop_fields(spark, sf_dir):
    return records.drop_fields(table(spark, sf_dir, "documents"), "text", "source", "no_such_field")


@query
def harmonize_union(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("text").alias("request"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("promt"))
    items = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("content"))
    both = records.union_corpora(turns, docs, items)
    return records.harmonize_fields(both, {"content": ["promt", "request"]})


@query
def wrap_content(spark, sf_dir):
    return records.wrap_content(table(spark, sf_dir, "benchmark"), "text")


@query
def shared_flag(spark, sf_dir):
    rows = _listing(spark, sf_dir)
    return rows.select("id", ftext.shared_flag(F.col("shared")).alias("flag"))


@query
def default_value(spark, sf_dir):
    return _states(spark, sf_dir).select("run_id", "step", ftext.with_default(F.col("loss"), 0.0).alias("loss"))


# --- joins


@query
def positional_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("n_chars").alias("quality"))
    labels = table(spark, sf_dir, "labels").select(
        F.col("quality").cast("bigint").alias("quality"), "toxic", F.col("doc_id").alias("label_id")
    )
    return positions.positional_join(docs, labels, "doc_id", "label_id")


@query
def positional_join_files(spark, sf_dir):
    """The same over files. Both are written sorted, so file order is the order of the keys."""
    jsonl, csv = scratch_path(spark, "left"), scratch_path(spark, "right")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("n_chars").alias("quality"))
    sinks.write_jsonl(docs.orderBy("doc_id"), jsonl)
    table(spark, sf_dir, "labels").select("quality", "toxic").orderBy("doc_id").write.option("header", True).csv(csv)
    joined = positions.positional_join_files(spark, jsonl, csv, "quality bigint, toxic bigint")
    fields = F.from_json("raw", "doc_id bigint, lang string, quality bigint, toxic bigint").alias("r")
    return joined.select("row_pos", fields).select("row_pos", "r.*")


@query
def compare_resume(spark, sf_dir):
    states = _states(spark, sf_dir).where(F.col("model_path").isin("view", "click", "signup"))
    names = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    checkpoints = names.select(
        F.concat(F.lit("run-"), F.col("user_id")).alias("run_id"),
        F.concat(F.lit("checkpoint-"), F.col("event_id")).alias("name"),
    )
    return runlog.compare_resume(states, checkpoints)


# --- aggregations


def _props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_parsed(table(spark, sf_dir, "events").select("event_id", F.col("props").alias("raw")))


@query
def count_json(spark, sf_dir):
    return profile.count_json(with_parsed(_document_lines(spark, sf_dir)))


@query
def extra_keys(spark, sf_dir):
    rows = profile.extra_keys(_props(spark, sf_dir), expected=("content",))
    return rows.select("event_id", F.array_join("extra_keys", ",").alias("extra_keys"))


@query
def key_profile(spark, sf_dir):
    return profile.key_profile(_props(spark, sf_dir))


@query
def key_profile_records(spark, sf_dir):
    lines = _pair_lines(spark, sf_dir)
    return profile.key_profile(with_parsed(lines))


@query
def corpus_stats(spark, sf_dir):
    return profile.corpus_stats(table(spark, sf_dir, "documents"), ["lang"], "text")


@query
def observed_counts(spark, sf_dir):
    rows, watch = profile.observed(
        table(spark, sf_dir, "documents").select("n_chars"),
        "progress",
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("n_chars").alias("n_chars"),
    )
    rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(watch.get["n_rows"], watch.get["n_chars"])], "n_rows bigint, n_chars bigint")


@query
def word_counts(spark, sf_dir):
    return profile.word_counts(documents(spark, sf_dir, "text"), "text", min_frequency=2)


@query
def word_counts_topk(spark, sf_dir):
    return profile.word_counts(documents(spark, sf_dir, "text"), "text", min_frequency=3, vocab_size=200)


@query
def term_postings(spark, sf_dir):
    return profile.term_postings(documents(spark, sf_dir, "doc_id", "text"), "text", "doc_id")


@query
def term_rows(spark, sf_dir):
    return profile.term_rows(documents(spark, sf_dir, "text"), "text", min_frequency=2)


def _stored_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.word_counts(documents(spark, sf_dir, "text"), "text")


@query
def pair_counts(spark, sf_dir):
    pairs = bpe.pair_counts(bpe.with_symbols(_stored_words(spark, sf_dir)))
    return pairs.select(
        F.col("left").cast("bigint").alias("left_code"), F.col("right").cast("bigint").alias("right_code"), "n"
    )


@query
def newest_checkpoint(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    name = F.when(F.col("event_type") == "error", "checkpoint-abc").when(
        F.col("event_type") == "view", F.concat(F.lit("state-"), F.col("event_id"))
    )
    names = events.select("user_id", F.coalesce(name, F.concat(F.lit("checkpoint-"), F.col("event_id"))).alias("name"))
    return runlog.newest_checkpoint(names, ["user_id"])


# --- windows


@query
def retain_last_n(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    kept = runlog.retain_last_n(events, ["user_id"], ["ts", "event_id"], 5)
    return kept.select("user_id", "event_id")


@query
def latest_per_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value")
    return runlog.latest_per_key(events, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value")


@query
def row_position(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return positions.row_position(docs, ["source", "doc_id"])


@query
def batch_of_n(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return positions.batch_of_n(events, ["ts", "event_id"], 64).select("event_id", "batch")


@query
def sample_every_n_steps(spark, sf_dir):
    return runlog.sample_every_n_steps(_states(spark, sf_dir), 500).select("run_id", "step", "loss")


# --- sorts, limits, union


@query
def sorted_listing(spark, sf_dir):
    states = table(spark, sf_dir, "events").select("event_id", format_stamp(F.col("ts")).alias("stamp"))
    return profile.sorted_listing(states, F.desc("stamp"), "event_id")


@query
def page(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return profile.page(pages, 100, ["url", "page_id"])


@query
def peek(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content")).orderBy("doc_id")
    return profile.peek(docs, "content", 1, 500)


# --- scalar functions


@query
def py_strip(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    padded = F.concat(F.lit(PAD_LEFT), F.col("text"), F.lit(PAD_RIGHT))
    return docs.select("doc_id", ftext.py_strip(padded).alias("content"))


@query
def single_line(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    ends = "".join(chr(c) for c in (0x0D, 0x0A, 0x85, 0x78, 0x0A))
    text = F.concat(F.replace(F.col("text"), F.lit(", "), F.lit(chr(0x2028))), F.lit(ends))
    return docs.select("doc_id", ftext.single_line(text).alias("content"))


@query
def collapse_ws(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    text = F.concat(F.replace(F.col("text"), F.lit(", "), F.lit(PAD_LEFT)), F.lit(PAD_RIGHT))
    return docs.select("doc_id", ftext.collapse_ws(text).alias("content"))


@query
def gunzip_decode(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    packed = docs.select("doc_id", _gzipped(text_bytes(F.col("text"))).alias("data"))
    return packed.select("doc_id", fblobs.decode_lossy(fblobs.gunzip(F.col("data"))).alias("content"))


@query
def decode_lossy(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    data = F.concat(F.unhex(F.lit("FFC3")), text_bytes(F.col("text")), F.unhex(F.lit("E282")))
    return docs.select("doc_id", fblobs.decode_lossy(data).alias("content"))


@query
def decode_as(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    wide = F.encode(F.col("text"), "UTF-16LE")
    data = F.when(F.col("lang") == "en", wide).otherwise(text_bytes(F.col("text")))
    charset = F.when(F.col("lang") == "en", "utf-16-le").when(F.col("lang") == "de", "no-such-charset").otherwise("utf-8")
    return docs.select("doc_id", fblobs.decode_as(data, charset).alias("content"))


@query
def repair_bytelevel(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    return docs.select("doc_id", ftext.repair_bytelevel(to_byte_text(F.col("text"))).alias("content"))


@query
def clean_generated(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    prompt = F.substring(ftext.collapse_ws(F.col("text")), 1, 7)
    text = F.concat(F.replace(F.col("text"), F.lit(" "), F.lit("Ġ")), F.lit(" Ã¶\n"))
    return turns.select("conv_id", "turn", ftext.clean_generated(text, prompt).alias("content"))


@query
def to_json_lines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    note = F.when(F.col("lang") != "en", F.col("lang")).alias("note")
    return docs.select(to_json_line(F.col("doc_id"), note, F.col("source"), F.col("n_chars")).alias("line"))


@query
def qa_concat(spark, sf_dir):
    pairs = _pairs(spark, sf_dir).where(F.col("question").isNotNull())
    text = ftext.qa_concat(F.col("question"), F.col("response"))
    return pairs.select("conv_id", "turn", text.alias("content"))


@query
def parse_stamp_text(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    stamp = F.when(F.col("event_type") == "error", "latest").otherwise(format_stamp(F.col("ts")))
    return events.select("event_id", utc_text(parse_stamp(stamp)).alias("ts"))


# --- tokenizer


@query
def pretokenize_words(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text").withColumn("words", pretokenize_ws(F.col("text")))
    return docs.select("doc_id", F.size("words").cast("bigint").alias("n_words"), digest(F.col("words")).alias("words"))


@query
def pretokenize_byte_level(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text").withColumn("words", pretokenize_bytes(F.col("text")))
    return docs.select("doc_id", F.size("words").cast("bigint").alias("n_words"), digest(F.col("words")).alias("words"))


@query
def alphabet(spark, sf_dir):
    rows = bpe.alphabet(_stored_words(spark, sf_dir))
    return rows.select("token", F.col("id").cast("bigint").alias("id"))


@query
def special_tokens(spark, sf_dir):
    """The special tokens with the number of documents that contain them as text."""
    special = bpe.special_tokens(spark)
    docs = documents(spark, sf_dir, "text")
    counts = [F.count_if(F.contains("text", F.lit(t))).alias(t) for t in bpe.SPECIAL_TOKENS]
    found = docs.agg(*counts).unpivot([], [f"`{t}`" for t in bpe.SPECIAL_TOKENS], "token", "n_rows")
    return special.join(found, "token").select("token", F.col("id").cast("bigint").alias("id"), "n_rows")


@query
def bpe_merges(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = bpe.bpe_train(docs, "text", VOCAB_SIZE, 2)
    return model.merge_table(spark).select(
        *[F.col(c).cast("bigint").alias(c) for c in ("rank", "left_id", "right_id", "id")]
    )


@query
def bpe_vocab_bytes(spark, sf_dir):
    return trained(spark, sf_dir, "bytes").vocab_table(spark).select("token", F.col("id").cast("bigint").alias("id"))


def _text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir, "text").select(ftext.single_line(F.col("text")).alias("content"))


@query
def piece_characters(spark, sf_dir):
    chars = pieces.covered_characters(pieces.marked_words(_text_lines(spark, sf_dir), "content"))
    return chars.select("symbol", "n", F.col("rank").cast("bigint").alias("rank"))


@query
def piece_vocab(spark, sf_dir):
    model = pieces.train_pieces(_text_lines(spark, sf_dir), "content", PIECE_VOCAB_SIZE)
    return model.table(spark).select("piece", F.col("id").cast("bigint").alias("id"))


@query
def piece_round_trip(spark, sf_dir):
    """A learned piece model written to its file, read back, and used both ways on every line."""
    path = scratch_path(spark, "piece-model") + "/tokenizer.model"
    piece_files.save_piece_model(pieces.train_pieces(_text_lines(spark, sf_dir), "content", PIECE_VOCAB_SIZE), spark, path)
    model = piece_files.load_piece_model(spark, path)
    lines = documents(spark, sf_dir, "doc_id", "text").select("doc_id", ftext.single_line(F.col("text")).alias("line"))
    coded = piece_codec.encode_pieces(lines, "line", model).select("doc_id", "input_ids")
    return piece_codec.decode_pieces(coded, "input_ids", model).select("doc_id", "content")


def _encoded(spark: SparkSession, sf_dir: str, max_length: int | None) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return tokens.encode(docs, "text", trained(spark, sf_dir), max_length).select("doc_id", "input_ids")


@query
def encode_truncate(spark, sf_dir):
    rows = _encoded(spark, sf_dir, tokens.MAX_LENGTH)
    return rows.select("doc_id", F.size("input_ids").cast("bigint").alias("n_ids"), digest(F.col("input_ids")).alias("ids"))


@query
def encode_bytes(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    rows = tokens.encode(docs, "text", trained(spark, sf_dir, "bytes"), None)
    return rows.select("doc_id", F.size("input_ids").cast("bigint").alias("n_ids"), digest(F.col("input_ids")).alias("ids"))


@query
def encode_tolerant(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    holed = docs.select("doc_id", F.when(F.col("lang") != "de", F.col("text")).alias("text"))
    rows = tokens.encode(holed, "text", trained(spark, sf_dir), None, on_error="keep")
    return rows.select("doc_id", F.size("input_ids").cast("bigint").alias("n_ids"), "error")


@query
def pad_to(spark, sf_dir):
    rows = _encoded(spark, sf_dir, None)
    padded = tokens.pad_to(F.col("input_ids"), PADDED_LENGTH, PAD_ID)
    return rows.select("doc_id", digest(padded).alias("ids"))


@query
def causal_batch(spark, sf_dir):
    rows = tokens.causal_batch(_encoded(spark, sf_dir, tokens.MAX_LENGTH), "doc_id", 4, PAD_ID)
    return rows.select(
        "doc_id",
        "batch",
        digest(F.col("input_ids")).alias("ids"),
        digest(F.col("attention_mask")).alias("mask"),
        digest(F.col("labels")).alias("labels"),
    )


@query
def decode_tokens(spark, sf_dir):
    model = trained(spark, sf_dir)
    rows = _encoded(spark, sf_dir, None)
    framed = rows.withColumn("input_ids", F.concat(F.array(F.lit(0)), "input_ids", F.array(F.lit(2))))
    return tokens.decode(framed, "input_ids", model).select("doc_id", "content")


# --- streaming


@query
def stream_corpus(spark, sf_dir):
    """JSON lines taken in by a stream, one file at a time, in two runs over the same folder."""
    folder, out, state = (scratch_path(spark, x) for x in ("intake", "cleaned", "intake-state"))
    # A few files, put together without a shuffle of the texts.
    lines = _document_lines(spark, sf_dir).coalesce(4)
    for _ in range(2):
        sinks.write_lines(lines, folder, mode="append")
        incremental_corpus(spark, folder, out, state, max_files_per_trigger=3).awaitTermination()
    return spark.read.schema("content string").json(out)


@query
def stream_tokens(spark, sf_dir):
    folder, out, state = (scratch_path(spark, x) for x in ("intake", "encoded", "intake-state"))
    sinks.write_lines(_document_lines(spark, sf_dir), folder)
    incremental_corpus(
        spark, folder, out, state, trained(spark, sf_dir), max_bytes_per_trigger=64 * 1024 * 1024
    ).awaitTermination()
    rows = files.scan_tokens(spark, out)
    return rows.select(F.size("input_ids").cast("bigint").alias("n_ids"), digest(F.col("input_ids")).alias("ids"))


@query
def stream_dead_letters(spark, sf_dir):
    folder, out, state = (scratch_path(spark, x) for x in ("intake", "bad-lines", "intake-state"))
    sinks.write_lines(_document_lines(spark, sf_dir), folder)
    incremental_dead_letters(spark, folder, out, state).awaitTermination()
    rows = spark.read.schema("file string, raw string").json(out)
    return rows.select("raw")


# --- user functions


@query
def map_rows(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return mapping.map_rows(
        turns,
        lambda r: {"conv_id": r["conv_id"], "turn": r["turn"], "content": f"{r['role']}: {r['text']}"},
        "conv_id bigint, turn bigint, content string",
    )


@query
def map_batches(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return mapping.map_batches(
        turns,
        lambda batch: pd.DataFrame({"n_chars": batch["text"].str.len()}),
        "conv_id bigint, turn bigint, n_chars bigint",
        drop=("role", "text"),
    )


@query
def lazy_map(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark")
    return mapping.lazy_map(
        items, lambda r: {"item_id": r["item_id"], "content": r["text"][::-1]}, "item_id bigint, content string"
    )
