import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from corpusloom.functions import batches
from corpusloom.llm import ngram_join
from corpusloom.llm.ngram_join import ngram_jaccard
from corpusloom.llm.toxicity import toxicity
from corpusloom.session import small_batches

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def default_batches(spark):
    spark.conf.unset(SETTING)
    yield
    spark.conf.unset(SETTING)


def by_ngrams(spark, docs, labels):
    ngram_jaccard(docs)


def by_toxicity(spark, docs, labels):
    toxicity(docs, labels)


def by_tokens(spark, docs, labels):
    corpus_pipeline.tokenize(spark, docs, "")


@pytest.mark.parametrize("step", [by_ngrams, by_toxicity, by_tokens])
def test_batches_of_long_texts_are_small(spark, default_batches, step):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, None)], "doc_id long, text string")
    step(spark, docs, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"))

    def size(found):
        for b in found:
            yield pa.RecordBatch.from_arrays([pa.array([len(b)]), pa.array([b.nbytes])], ["n", "bytes"])

    texts = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 4000) AS text")
    seen = texts.mapInArrow(size, "n long, bytes long").collect()
    assert sum(r.n for r in seen) == 3000
    assert max(r.bytes for r in seen) < 3 << 20


def test_a_smaller_batch_setting_of_the_caller_stays(spark, default_batches):
    spark.conf.set(SETTING, "64k")
    small_batches(spark)
    assert spark.conf.get(SETTING) == "64k"
    spark.conf.set(SETTING, "1g")
    small_batches(spark)
    assert int(spark.conf.get(SETTING)) == 1 << 20


def counting(spark, monkeypatch, width):
    """The function that counts shingles in a task, to be called here."""
    found, frame = [], type(spark.range(0))
    real = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, f, *a, **b: found.append(f) or real(self, f, *a, **b))
    ngram_join._frequent(spark.createDataFrame([("a",)], "text string"), "text", width)
    return found[0]


def test_counting_shingles_holds_little_more_than_what_is_pending(spark, monkeypatch):
    count = counting(spark, monkeypatch, 1)
    texts = [" ".join(f"{i:x}" for i in range(k, k + 20_000)) for k in range(0, 2_600_000, 20_000)]
    texts += [texts[0]] * 3
    parts = [pa.RecordBatch.from_arrays([pa.array(texts[i : i + 5])], ["text"]) for i in range(0, len(texts), 5)]
    del texts
    tracemalloc.start()
    try:
        out = list(count(iter(parts)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # 16 MB are pending at once.
    assert peak < 60 << 20
    # The last three copies stand in one block, apart from the first text.
    assert out[0].num_rows == 0


def test_repeats_are_counted_in_blocks(monkeypatch):
    monkeypatch.setattr(ngram_join, "_PENDING", 1000)
    met, rng, expected, block = ngram_join._Repeats(), np.random.default_rng(1), Counter(), []

    def close():
        expected.update({k: n for k, n in Counter(block).items() if n > 1})
        block.clear()

    most = 1000
    for size in [10, 300, 500, 0, 400, 2500, 900, 999, 1, 30] * 3:
        s = np.unique(rng.integers(0, 4000, size))
        if len(block) + len(s) > most:
            close()
            most = max(most, len(s))
        block += s.tolist()
        met.add(s)
    close()
    met.merge()
    assert dict(zip(met.values.tolist(), met.n.tolist())) == dict(expected)


def test_memory_is_given_back_after_the_last_batch(monkeypatch):
    log = []
    monkeypatch.setattr(batches, "give_back", lambda: log.append("back"))

    @batches.giving_back
    def work(parts):
        for p in parts:
            log.append(p)
            yield p

    assert list(work(iter([1, 2]))) == [1, 2]
    assert log == [1, 2, "back"]
