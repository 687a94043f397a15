import duckdb
import pytest

import corpus_pipeline
from check import TABLES, normalized
from corpusloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_statement(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = QUERIES[name](spark, SF)
    cursor = con.execute(ORACLES[name])
    assert normalized(df.columns, [tuple(r) for r in df.collect()]) == normalized([d[0] for d in cursor.description], cursor.fetchall())


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_keep_what_they_should(spark):
    words = [f"w{i}" for i in range(100)]
    near = words[:50] + ["other"] + words[51:]
    rows = [(1, " ".join(words), "en", "a", 1), (2, " ".join(near), "en", "a", 1), (3, "alone " * 3, "en", "b", 1), (4, "alone " * 3, "de", "b", 1), (5, None, None, None, None), (6, "", "en", "a", 0), (6, "", "en", "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    once = stage("exact dedup")(spark, docs, SF)
    assert once.columns == docs.columns
    assert sorted(r.doc_id for r in once.collect()) == [1, 2, 4, 6]
    apart = stage("n-gram Jaccard join")(spark, docs, SF)
    assert apart.columns == docs.columns
    assert sorted(r.doc_id for r in apart.collect()) == [1, 3, 5, 6, 6]
    mixed = stage("mixing")(spark, docs, SF)
    assert mixed.columns == docs.columns
    tokens = stage("byte-level BPE")(spark, docs, SF)
    assert tokens.count() == 7 and tokens.where("n_tokens * 4 <> octet_length(token_ids)").count() == 0
    for _, f in corpus_pipeline.STAGES[1:]:
        assert f(spark, docs.limit(0), SF).count() == 0


def test_the_whole_pipeline(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "text", "lang", "source", "n_chars", "token_ids", "n_tokens"} == set(out.columns)
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert ids and sum(i in toxic for i in set(ids)) < 0.4 * len(toxic)
