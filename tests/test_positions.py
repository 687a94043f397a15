import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import positions
from corpusloom.sources import files


def test_row_position_is_contiguous(spark):
    frame = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("g"))
    got = positions.row_position(frame.repartition(7), ["g", F.desc("k")]).collect()
    want = sorted(((r.g, -r.k) for r in got))
    assert [(r.g, -r.k) for r in sorted(got, key=lambda r: r.row_pos)] == want
    assert sorted(r.row_pos for r in got) == list(range(5000))


def test_batches(spark):
    got = positions.batch_of_n(spark.range(10), "id", 4).orderBy("id").collect()
    assert [r.batch for r in got] == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2]


@pytest.fixture
def small_splits(spark):
    """Files cut into many small blocks."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "1000")
    spark.conf.set(names[1], "0")
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def test_file_order_over_files_and_blocks(spark, tmp_path, small_splits):
    # The larger file sorts last, so that tasks do not follow file order.
    (tmp_path / "a.txt").write_text("".join(f"a{i}\n" for i in range(100)))
    (tmp_path / "b.txt").write_text("".join(f"b{i}-{'x' * (i % 50)}\n" for i in range(1000)))
    (tmp_path / "c.txt").write_text("")
    scan = files.scan_lines_in_order(spark, str(tmp_path))
    got = positions.file_position(scan).orderBy("row_pos").collect()
    want = [f"a{i}" for i in range(100)] + [f"b{i}-{'x' * (i % 50)}" for i in range(1000)]
    assert [r.raw for r in got] == want
    assert [r.row_pos for r in got] == list(range(1100))


def updated(lines, table):
    out = []
    for i, line in enumerate(lines):
        item = json.loads(line)
        if i < len(table):
            item.update(table[i])
        out.append(item)
    return out


@pytest.mark.parametrize("n_csv", [0, 3, 500, 700])
def test_positional_join_files(spark, tmp_path, small_splits, n_csv):
    lines = [json.dumps({"content": f"çay {i}", "n": i}, ensure_ascii=False) for i in range(500)]
    (tmp_path / "l.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
    table = [{"n": -i, "note": None if i % 3 == 0 else f"r{i}"} for i in range(n_csv)]
    cells = "".join(f"{r['n']},{r['note'] or ''}\n" for r in table)
    (tmp_path / "r.csv").write_text("n,note\n" + cells)
    got = positions.positional_join_files(spark, str(tmp_path / "l.jsonl"), str(tmp_path / "r.csv"), "n int, note string")
    assert [json.loads(r.raw) for r in got.orderBy("row_pos").collect()] == updated(lines, table)


def test_positional_join_typed(spark):
    left = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30)], "k int, s string, v int")
    right = spark.createDataFrame([(9, None, "x"), (8, 5, "y")], "o int, v int, extra string")
    got = positions.positional_join(left, right, "k", "o").orderBy("row_pos").collect()
    assert [(r.k, r.s, r.v, r.o, r.extra) for r in got] == [
        (1, "a", 5, 8, "y"),
        (2, "b", None, 9, "x"),
        (3, "c", 30, None, None),
    ]
