from datetime import datetime

from pyspark.sql import functions as F

from corpusloom.operators import mapping, profile, runlog
from corpusloom.sources import files, sinks


def at(minute):
    return datetime(2024, 1, 1, 0, minute)


STATES = [
    ("r1", 0, 0.0, None, at(0), "m"),
    ("r1", 499, 0.1, 1.0, at(1), "m"),
    ("r1", 500, 0.2, None, at(2), "m"),
    ("r1", 1000, 0.3, 0.5, at(3), "m"),
    ("r1", 1500, 0.4, 0.4, at(4), "m"),
    ("r1", 1501, 0.4, 0.4, at(4), "m"),
    ("r1", 1400, 0.4, 0.4, at(3), "m"),
    ("r2", 500, 0.2, 0.9, at(2), "m"),
    ("r3", 700, 0.2, 0.9, at(2), "m"),
]
SCHEMA = files.RUN_STATE_SCHEMA


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    for state in STATES:
        sinks.append_run_state(spark.createDataFrame([state], SCHEMA), path)
    log = files.scan_run_states(spark, path)
    assert log.count() == len(STATES)
    kept = runlog.retain_last_n(log, ["run_id"], ["ts", "step"], 5)
    assert sorted(r.step for r in kept.where("run_id = 'r1'").collect()) == [500, 1000, 1400, 1500, 1501]
    latest = {r.run_id: r.step for r in runlog.latest_per_key(log, ["run_id"], ["ts", "step"]).collect()}
    assert latest == {"r1": 1501, "r2": 500, "r3": 700}
    sampled = sorted((r.run_id, r.step, r.loss) for r in runlog.sample_every_n_steps(log).collect())
    assert sampled == [("r1", 500, 0.0), ("r1", 1000, 0.5), ("r1", 1500, 0.4), ("r2", 500, 0.9)]


def test_many_kept_rows(spark):
    frame = spark.range(6000).select((F.col("id") % 2).alias("run"), F.col("id").alias("ts"))
    got = runlog.retain_last_n(frame, ["run"], ["ts"], 1500).collect()
    assert sorted(r.ts for r in got) == list(range(3000, 6000))


def test_resume(spark):
    states = spark.createDataFrame(STATES, SCHEMA)
    names = [("r1", "checkpoint-1600"), ("r1", "checkpoint-90"), ("r1", "checkpoint-abc"), ("r2", "checkpoint-500"), ("r4", "checkpoint-3"), ("r3", "runs")]
    checkpoints = spark.createDataFrame(names, "run_id string, name string")
    got = {r.run_id: tuple(r)[1:] for r in runlog.compare_resume(states, checkpoints).collect()}
    assert got == {
        "r1": (1501, 1600, "checkpoint-1600", True),
        "r2": (500, 500, "checkpoint-500", False),
        "r3": (700, None, "state", False),
        "r4": (None, 3, "checkpoint-3", False),
    }
    assert runlog.newest_checkpoint(checkpoints).first().checkpoint == 1600


def test_rank_limit_runs_before_the_shuffle(spark, tmp_path):
    spark.createDataFrame(STATES, SCHEMA).write.parquet(str(tmp_path / "s"))
    log = spark.read.parquet(str(tmp_path / "s"))
    plan = runlog.retain_last_n(log, ["run_id"], ["ts"], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_listing_is_stable(spark):
    frame = spark.createDataFrame([(2, "b"), (1, "z"), (2, "a"), (1, "y")], "k int, v string").coalesce(1)
    got = [(r.k, r.v) for r in profile.sorted_listing(frame, "k").collect()]
    assert got == [(1, "z"), (1, "y"), (2, "b"), (2, "a")]


def test_term_rows_and_counters(spark):
    docs = spark.createDataFrame([(1, "Selam nasılsın iyimisin"), (2, "Selam kötüyüm selam Selam"), (3, "...")], "id int, t string")
    got = {r.word: (r.n_rows, r.n) for r in profile.term_rows(docs, "t", 2).collect()}
    assert got == {"Selam": (2, 3)}
    postings = sorted((r.word, r.id, r.n_in_row) for r in profile.term_postings(docs, "t", "id").collect())
    assert ("Selam", 2, 2) in postings and len(postings) == 7
    watched, watch = profile.observed(docs, "seen")
    assert watched.count() == 3 and watch.get == {"n_rows": 3}
    assert [r.content for r in profile.peek(docs.select(F.col("t").alias("content")), rows=1, chars=5).collect()] == ["Selam"]
    assert [r.id for r in profile.page(docs, 2, [F.desc("id")]).collect()] == [3, 2]
    stats = profile.corpus_stats(docs.select(F.col("t").alias("content"))).first()
    assert (stats.n_rows, stats.n_texts) == (3, 3)


def test_user_functions(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, "c")], "id int, text string")
    rows = mapping.map_rows(frame, lambda r: {"id": r["id"], "n": len(r["text"])}, "id int, n int")
    assert sorted(tuple(r) for r in rows.collect()) == [(1, 3), (2, 1)]
    batches = mapping.map_batches(
        frame, lambda b: b[["text"]].rename(columns={"text": "up"}).apply(lambda c: c.str.upper()), "id int, up string", drop=["text"]
    )
    assert sorted(tuple(r) for r in batches.collect()) == [(1, "A B"), (2, "C")]
    assert mapping.lazy_map(spark.range(10**9), lambda r: {"id": r["id"]}, "id bigint").limit(1).count() == 1
