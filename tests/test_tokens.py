import pytest
from pyspark.sql import functions as F
from test_bpe import library, vocabulary

from corpusloom.operators import bpe, tokens
from corpusloom.plans.flows import corpus_to_tokens
from corpusloom.sources import files

TRAINING = ["the cat sat on the mat the end", "Selam nasılsın iyimisin Selam kötüyüm", "a-b--c 12 12 %% {} don't"]
TEXTS = [
    "the cat",
    "a<s>b <mask>",
    "!<s>!!</s></s>the<pad>",
    "",
    " \n ",
    "unseen: 漢字 Ω the",
    "  lead  two\n\nlines\t",
    "<<s>> <s <unk",
    "Selam Selam",
    "x" * 5000 + " the",
]


def model_of(tok, words="ws"):
    return bpe.BpeModel(*vocabulary(tok), words=words)


@pytest.mark.parametrize("words", ["ws", "bytes"])
def test_encode_and_decode_match_library(rows, words):
    tok = library(TRAINING, 70, 1, words)
    model = model_of(tok, words)
    encoded = tokens.encode(rows(TEXTS), "text", model, None)
    got = {r.i: r.input_ids for r in encoded.collect()}
    assert [got[i] for i in range(len(TEXTS))] == [tok.encode(t).ids for t in TEXTS]
    back = {r.i: r.back for r in tokens.decode(encoded, "input_ids", model, out="back").collect()}
    assert [back[i] for i in range(len(TEXTS))] == [tok.decode(got[i]) for i in range(len(TEXTS))]
    full = {r.i: r.back for r in tokens.decode(encoded, "input_ids", model, False, "back").collect()}
    assert full[1] == tok.decode(got[1], skip_special_tokens=False)


def test_errors_and_limits(spark, rows):
    model = model_of(library(TRAINING, 70, 1))
    frame = rows(["the cat sat", None, "the"])
    assert sorted(r.i for r in tokens.encode(frame, "text", model).collect()) == [0, 2]
    kept = tokens.encode(frame, "text", model, 2, on_error="keep").orderBy("i").collect()
    assert [(r.input_ids and len(r.input_ids), r.error) for r in kept] == [(2, None), (None, "no text"), (1, None)]
    long = rows(["the " * 9000])
    assert len(tokens.encode(long, "text", model).first().input_ids) == 8192


def test_pad_and_batch(spark):
    frame = spark.createDataFrame([(0, [5, 6, 7]), (1, [8]), (2, []), (3, [9, 1]), (4, [4])], "i int, input_ids array<int>")
    padded = frame.select(tokens.pad_to(F.col("input_ids"), 2).alias("p"), "i").orderBy("i").collect()
    assert [r.p for r in padded] == [[5, 6], [8, 1], [1, 1], [9, 1], [4, 1]]
    got = tokens.causal_batch(frame, "i", 2).orderBy("i").collect()
    assert [r.batch for r in got] == [0, 0, 1, 1, 2]
    assert [r.input_ids for r in got] == [[5, 6, 7], [8, 1, 1], [1, 1], [9, 1], [4]]
    assert [r.attention_mask for r in got] == [[1, 1, 1], [1, 0, 0], [0, 0], [1, 1], [1]]
    assert [r.labels for r in got] == [[5, 6, 7], [8, -100, -100], [-100, -100], [9, -100], [4]]


def test_corpus_to_tokens_skips_finished_stages(spark, tmp_path):
    corpus = tmp_path / "corpus.jsonl"
    corpus.write_text('{"content": "the cat the cat"}\n{bad\n{"content": " "}\n{"content": 5}\n{"content": "the mat"}\n')
    tok, out = str(tmp_path / "tok"), str(tmp_path / "out")
    model = corpus_to_tokens(spark, str(corpus), tok, out, 30, 1)
    want = library(["the cat the cat", "the mat"], 30, 1)
    assert (model.tokens, model.merges) == vocabulary(want)
    rows = sorted(r.input_ids for r in files.scan_tokens(spark, out).collect())
    assert rows == sorted(want.encode(t).ids for t in ("the cat the cat", "the mat"))
    corpus.write_text('{"content": "other"}\n')
    assert corpus_to_tokens(spark, str(corpus), tok, out, 99, 1) == model
    assert files.scan_tokens(spark, out).count() == 2


def test_encode_needs_no_shuffle(spark, tmp_path):
    spark.createDataFrame([("the",)], "text string").write.parquet(str(tmp_path / "t"))
    frame = tokens.encode(spark.read.parquet(str(tmp_path / "t")), "text", model_of(library(TRAINING, 70, 1)))
    assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()


def test_causal_batch_makes_each_row_once_and_keeps_ties_in_input_order(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<int>")
    def ids(i):
        made.add(1)
        return [i] * (i % 5)

    frame = spark.range(40, numPartitions=3).select(F.col("id").cast("int").alias("i"), F.lit(7).alias("same"), ids.asNondeterministic()("id").alias("input_ids"))
    got = tokens.causal_batch(frame, [F.desc("same")], 4).collect()
    assert made.value == 40
    assert {r.i: r.batch for r in got} == {i: i // 4 for i in range(40)}
    for r in got:
        width = max(i % 5 for i in range(r.batch * 4, r.batch * 4 + 4))
        assert r.input_ids == [r.i] * (r.i % 5) + [1] * (width - r.i % 5)
        assert r.attention_mask == [1] * (r.i % 5) + [0] * (width - r.i % 5)
    by_size = tokens.causal_batch(frame, F.size("input_ids"), 8).collect()
    assert {r.i % 5: r.batch for r in by_size} == {k: k for k in range(5)}
