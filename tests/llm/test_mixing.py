import math

from pyspark.sql import functions as F

from corpusloom.llm.mixing import copies, mixed, source_rates


def test_copies_follow_the_poisson_distribution(spark):
    for rate in (0.3, 1.0, 20.0):
        row = spark.range(8000).select(copies(F.col("id").cast("string"), F.lit(rate), 3).alias("n")).agg(F.avg("n"), F.variance("n")).first()
        assert abs(row[0] - rate) < 5 * math.sqrt(rate / 8000)
        assert abs(row[1] - rate) < 0.15 * rate


def test_a_number_of_copies_is_the_inverse_of_the_distribution(spark):
    import hashlib

    got = {r.id: r.n for r in spark.range(300).select("id", copies(F.col("id").cast("string"), F.lit(1.7), 9).alias("n")).collect()}
    for i, n in got.items():
        u = (int(hashlib.sha256(f"9|1|{i}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
        k, reached, term = 0, math.exp(-1.7), math.exp(-1.7)
        while u > reached:
            k += 1
            term *= 1.7 / k
            reached += term
        assert n == k


def test_sources_reach_their_weights_and_rows_repeat_whole(spark):
    rows = [(i, "x" * 10, "a" if i % 3 else None, i) for i in range(3000)] + [(9000, None, "b", 1), (9001, "", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, `mixing k` int")
    out = mixed(docs, {"a": 1.0, None: 3.0}, numbered=True)
    assert out.columns == [*docs.columns, "copy", "shuffle_key"]
    got = out.collect()
    share = sum(r.source is None for r in got) / len(got)
    assert abs(share - 0.75) < 0.03 and abs(len(got) - 3000) < 250
    assert len({(r.doc_id, r.copy) for r in got}) == len(got)
    assert {r.source for r in got} == {"a", None}
    assert mixed(docs, {"a": 1.0, None: 3.0}).exceptAll(out.drop("copy", "shuffle_key")).count() == 0


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixed(empty).count() == 0 and source_rates(empty).count() == 0
    one = spark.createDataFrame([(None, "abc", None), (None, "abc", None)], "doc_id long, text string, source string")
    assert mixed(one, {"other": 1.0}).count() == 0
    assert mixed(one).count() % 2 == 0
