import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpusloom.functions.batches import in_parts
from corpusloom.functions.blobs import _decode_as
from corpusloom.llm.bpe_codec import _encoder, decoded, encoded, round_trip
from corpusloom.llm.ngram_join import _sets
from corpusloom.llm.queries import public_ranks
from corpusloom.operators.bpe import bpe_train
from corpusloom.operators.piece_codec import decode_pieces, encode_pieces
from corpusloom.operators.pieces import CONTROL_SYMBOLS, MARK, USER_SYMBOLS, PieceModel, byte_pieces
from corpusloom.operators.tokens import encode_words
from corpusloom.plans import queries


def test_parts_are_small_and_keep_all_rows_in_order():
    texts = pa.array(["x" * n for n in (10, 5000, 20, 30, 0, 700)] + [None])
    found = list(in_parts([texts, texts.slice(0, 0)], 1000))
    assert [t for p in found for t in p.to_pylist()] == texts.to_pylist()
    assert all(len(p) <= 1 or p.nbytes <= 1000 for p in found)
    assert len(found) > 2


def captured(monkeypatch, make):
    """The Arrow functions that are made, to be called here."""
    found, real = [], F.arrow_udf
    monkeypatch.setattr(F, "arrow_udf", lambda kind: lambda f: found.append(f) or real(kind)(f))
    make()
    return found


def test_pieces_are_coded_in_small_parts(spark, monkeypatch):
    model = PieceModel((*CONTROL_SYMBOLS, *USER_SYMBOLS, *byte_pieces(), "ab", MARK), 1)
    lines = spark.createDataFrame([("ab ab",)], "line string")
    to_ids, to_text = captured(
        monkeypatch, lambda: decode_pieces(encode_pieces(lines, "line", model), "input_ids", model)
    )
    texts = ["ab c" * 300_000, None, "ab"] * 4
    ids = list(to_ids(iter([pa.array(texts)])))
    assert len(ids) >= 4 and sum(map(len, ids)) == 12
    whole = pa.concat_arrays(ids)
    back = list(to_text(iter([whole])))
    assert len(back) >= 4 and [t for p in back for t in p.to_pylist()] == texts


def test_word_lists_are_encoded_in_small_parts(spark, monkeypatch):
    docs = spark.createDataFrame([("ab ab cd",)] * 3, "text string")
    model = bpe_train(docs, "text", 20, 2)
    (to_ids,) = captured(monkeypatch, lambda: encode_words(spark, F.array(F.lit("ab")), model, None))
    rows = [["ab", "cd"] * 200_000, None, [], ["ab"]] * 3
    out = list(to_ids(iter([pa.array(rows, pa.list_(pa.string()))])))
    assert len(out) >= 3
    ids = [r for p in out for r in p.to_pylist()]
    assert [None if r is None else len(r) for r in ids] == [None if r is None else len(ids[3]) * len(r) for r in rows]


def test_byte_level_ids_are_made_in_small_parts(spark, monkeypatch):
    path, pattern = public_ranks()
    docs = spark.createDataFrame([("ab",)], "text string")
    to_ids, to_bytes, both = captured(
        monkeypatch,
        lambda: (encoded(F.lit("a"), path, pattern), decoded(F.lit(b"a"), path), round_trip(docs, path, pattern, keep=())),
    )
    texts = ["ab cé" * 300_000, None, "ab"] * 4
    ids = list(to_ids(iter([pa.array(texts)])))
    assert len(ids) >= 4 and sum(map(len, ids)) == 12
    assert not _encoder(path, pattern).known and not _encoder(path, pattern).fits
    back = list(to_bytes(iter([pa.concat_arrays(ids)])))
    assert len(back) >= 4 and [t.decode() for p in back for t in p.to_pylist()] == [t or "" for t in texts]
    rows = list(both(iter([pa.array(texts)])))
    assert len(rows) >= 4 and [r["decoded"].decode() for p in rows for r in p.to_pylist()] == [t or "" for t in texts]


def test_shingle_sets_are_made_in_small_parts(spark, monkeypatch):
    docs, made = spark.createDataFrame([(1, "a")], "doc_id long, text string"), []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: made.append(f))
    last = spark.sparkContext.broadcast((np.zeros(0, np.int64), np.zeros(0, np.int64)))
    _sets(docs, "text", "doc_id", 5, 80, 100, last)
    texts = ["some words of a text " * 40_000, None, "a b"] * 4
    batch = pa.RecordBatch.from_arrays([pa.array(range(12)), pa.array(texts)], ["doc_id", "text"])
    out = list(made[0](iter([batch])))
    assert len(out) >= 4 and [r["doc_id"] for p in out for r in p.to_pylist()] == list(range(12))
    assert [r["n"] for p in out for r in p.select(["n"]).to_pylist()] == [5, 0, 1] * 4


def test_bytes_are_decoded_in_small_parts():
    texts = ["ä" * 500_000, None, "b"] * 4
    data = pa.array([t and t.encode("utf-16-le") for t in texts], pa.binary())
    out = list(_decode_as.func(iter([(data, pa.array(["utf-16-le"] * 12))])))
    assert len(out) >= 4 and [t for p in out for t in p.to_pylist()] == texts


def test_stream_corpus_writes_its_lines_without_a_shuffle(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(queries, "spread", lambda df: df)
    real = queries.sinks.write_lines
    monkeypatch.setattr(
        queries.sinks, "write_lines", lambda df, *a, **k: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, *a, **k)
    )
    queries.stream_corpus(spark, "/root/testdata/sf0.001")
    assert len(plans) == 2 and not any("Exchange" in p for p in plans)
