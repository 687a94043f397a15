import json

from test_bpe import library, vocabulary

from corpusloom.operators import bpe
from corpusloom.sources import files
from corpusloom.streaming.intake import incremental_corpus, incremental_dead_letters


def put(folder, name, contents):
    folder.mkdir(exist_ok=True)
    lines = [c if c.startswith("{") else json.dumps({"content": c}) for c in contents]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_only_new_files_are_read(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    put(folder, "a.jsonl", ["one", "{bad", "  ", "two"])
    put(folder, "b.jsonl", ["three"])
    query = incremental_corpus(spark, str(folder), out, state, max_files_per_trigger=1)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 2
    assert sorted(r.content for r in spark.read.json(out).collect()) == ["one", "three", "two"]
    put(folder, "c.jsonl", ["four", "one"])
    for _ in range(2):
        incremental_corpus(spark, str(folder), out, state).awaitTermination()
    assert sorted(r.content for r in spark.read.json(out).collect()) == ["four", "one", "one", "three", "two"]


def test_stream_encodes_as_batch(spark, tmp_path):
    texts = ["the cat sat", "on the mat", "<s>the"]
    tok = library(texts, 40, 1)
    folder, out = tmp_path / "in", str(tmp_path / "out")
    put(folder, "a.jsonl", texts)
    model = bpe.BpeModel(*vocabulary(tok))
    incremental_corpus(spark, str(folder), out, str(tmp_path / "state"), model, max_bytes_per_trigger=1).awaitTermination()
    got = sorted(r.input_ids for r in files.scan_tokens(spark, out).collect())
    assert got == sorted(tok.encode(t).ids for t in texts)


def test_dead_letters(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    put(folder, "a.jsonl", ["x", "{bad"])
    put(folder, "b.jsonl", ["{worse"])
    incremental_dead_letters(spark, str(folder), out, str(tmp_path / "state")).awaitTermination()
    got = {r.file.rsplit("/", 1)[1]: r.raw for r in spark.read.json(out).collect()}
    assert got == {"a.jsonl": "{bad", "b.jsonl": "{worse"}
