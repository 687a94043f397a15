"""Near-duplicate removal by MinHash with tensored banding.

A document has two small collections of ``HALVES`` keys, each made of ``DEPTH`` minima of hashed shingles. A
table is a pair of them, one from each collection, so ``2 * HALVES * DEPTH`` minima give ``HALVES ** 2`` tables
of ``2 * DEPTH`` minima; separate tables would need ``2 * HALVES ** 2 * DEPTH``. Two sets meet in a table if
they agree in a key of both collections. At similarity 0.85 they fail to with a probability of about
``2 * (1 - 0.85 ** 3) ** 12``, 2 in 100,000; above that it falls quickly.

* Equal sets are one node from the start. Keys that one node alone has make no table entries.
* Each node is first compared with the smallest node that it meets in any table. That joins most copies
  by one comparison each. In some more rounds, each node is compared with the first nodes of other classes that it
  meets, in orders that change from round to round, so that the parts of a large group find each other without pairing
  it with itself. Rounds only save comparisons.
* In tables where different classes still meet, every pair of two classes is compared in the first table in
  which it meets, in tasks, by size and parity bitmaps, whose distance never exceeds the true one.
  Buckets are dealt in blocks, the class of a bucket's smallest node apart, so that no
  bucket lands in one task and a large class is not compared with itself.
* Every pair left is verified on the whole sets of both texts. No bucket is capped.

A null or empty text, or one without words, has an empty set and no links. Rows that share a ``doc_id`` are one
document, linked by any of their texts; each is returned. A null ``doc_id`` links with nothing, has no component
and is kept. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.graph import connected_components
from corpusloom.llm.ngram_join import _bitmap, _folded, _may_link
from corpusloom.llm.shingles import Shingler
from corpusloom.session import written

# Keys of a collection, and minima of a key.
HALVES = 12
DEPTH = 3
# Rounds after the first, and the comparisons of a node in each.
ROUNDS = 1
TURNS = 3
# Nodes compared at a time: a side of a block, the texts that meet one pivot in a task, pairs in memory.
BLOCK = 512
PART = 128
_PAIRS = 1 << 20
# Shingles hashed at a time.
_SHINGLES = 1 << 16

_MULTIPLY, _ADD = np.random.default_rng(20240).integers(0, 1 << 63, (2, 2 * HALVES * DEPTH), dtype=np.uint64)
_MULTIPLY = _MULTIPLY * np.uint64(2) + np.uint64(1)


def _stirred(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def half_keys(sets: list[np.ndarray]) -> np.ndarray:
    """The keys of both collections of each set that is not empty, one row a set."""
    out = np.full((len(sets), 2 * HALVES * DEPTH), np.iinfo(np.uint64).max, dtype=np.uint64)
    i = 0
    while i < len(sets):
        j, size = i, 0
        while j < len(sets) and (j == i or size + len(sets[j]) <= _SHINGLES):
            size += len(sets[j])
            j += 1
        starts = np.cumsum([0] + [len(s) for s in sets[i : j - 1]])
        flat = np.concatenate(sets[i:j]).view(np.uint64)
        for c in range(out.shape[1]):
            hashed = _stirred(flat * _MULTIPLY[c] + _ADD[c])
            out[i:j, c] = np.minimum.reduceat(hashed, starts)
        i = j
    keys = np.arange(1, 2 * HALVES + 1, dtype=np.uint64)[None, :].repeat(len(sets), 0)
    for d in range(DEPTH):
        keys = _stirred(keys + out[:, d::DEPTH] * _MULTIPLY[d])
    return keys.view(np.int64)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            sets = list(shingler.sets(batch.column(2)))
            filled = [s for s in sets if len(s)]
            keys = half_keys(filled) if filled else np.zeros((0, 2 * HALVES), np.int64)
            ends = np.cumsum([0] + [2 * HALVES * bool(len(s)) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.ravel(), pa.int64())),
                    pa.array([_bitmap(s) for s in sets], pa.binary()),
                ],
                ["doc_id", "mark", "n", "digest", "keys", "bitmap"],
            )

    return docs.mapInArrow(rows, "doc_id long, mark long, n int, digest binary, keys array<long>, bitmap binary")


def _entries(keyed: DataFrame) -> DataFrame:
    """The table entries of each node: ``table`` key, and the places ``i, j`` of the halves it is made of."""
    kept = [c for c in keyed.columns if c not in ("first", "second")]
    one = keyed.select(*kept, F.explode("first").alias("x"), "second")
    both = one.select(*kept, "x", F.explode("second").alias("y"))
    return both.select(*kept, F.xxhash64("x.key", "y.key").alias("table"), F.col("x.at").alias("i"), F.col("y.at").alias("j"))


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The pairs ``a, b`` that link on their whole sets.

    The texts that are compared with one ``b`` follow it in a task, at most about ``PART`` in each.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, pivot = Shingler(width), np.zeros(0, np.int64)
        for batch in batches:
            found_a, found_b = [], []
            for b, a, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), shingler.sets(batch.column(2))):
                if a == b:
                    pivot = s
                    continue
                same = len(np.intersect1d(pivot, s, assume_unique=True))
                if den * same >= num * (len(pivot) + len(s) - same):
                    found_a.append(a)
                    found_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], ["a", "b"])

    ids = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = nodes.select("node", "doc_id", "mark").join(ids, "node", "left_semi")
    # Rows that repeat id and text are one.
    texts = written(docs.join(wanted, ["doc_id", "mark"]).groupBy("node").agg(F.min("text").alias("text")), "texts")
    parts = pairs.groupBy("b").agg(F.ceil(F.count("*") / F.lit(PART)).cast("int").alias("parts"))
    others = pairs.join(parts, "b").join(texts, F.col("a") == F.col("node")).select(
        "b", "a", "text", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part")
    )
    pivots = parts.join(texts, F.col("b") == F.col("node")).select(
        "b", F.col("b").alias("a"), "text", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    rows = pivots.union(others).repartition("b", "part").sortWithinPartitions("b", "part", F.col("a") != F.col("b"))
    return rows.select("b", "a", "text").mapInArrow(compare, "a long, b long")


def _open_entries(keyed: DataFrame) -> DataFrame:
    """The entries of tables in which several classes meet, of halves with their node's ``component``."""
    entries = _entries(keyed)
    several = entries.groupBy("table").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return entries.join(several.select("table"), "table").drop("component")


def _round_pairs(entries: DataFrame, turns: list[int]) -> DataFrame:
    """For each node and turn the first node of another class that leads one of its tables, in the order of the turn."""
    orders = {
        f"lead{t}": F.struct(F.xxhash64("node", F.lit(t)).alias("order"), F.col("node").alias("b"), F.col("component").alias("other"))
        for t in turns
    }
    leads = entries.groupBy("table").agg(*[F.min(o).alias(name) for name, o in orders.items()])
    met = entries.select("table", "node", "component").join(leads, "table")
    others = [F.min(F.when(F.col("component") != F.col(f"{name}.other"), F.col(name))).alias(name) for name in orders]
    chosen = met.groupBy(F.col("node").alias("a")).agg(*others)
    pairs = chosen.select("a", F.explode(F.array(*[F.col(f"{name}.b") for name in orders])).alias("b")).where("b is not null")
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _open_pairs(entries: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs of nodes of two classes that meet in a table and whose bitmaps are close."""
    several = entries.groupBy("table").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")
    ).where("low < high")
    met = entries.join(several.select("table", "low", "size"), "table")
    main = met.groupBy("table").agg(F.count(F.when(F.col("component") == F.col("low"), 1)).alias("main"))
    # The class of the lowest node takes blocks 0 .. p-1 and meets only the others, in blocks p .. p+q-1.
    p, q = F.ceil(F.col("main") / F.lit(BLOCK)).cast("int"), F.ceil((F.col("size") - F.col("main")) / F.lit(BLOCK)).cast("int")
    own = F.when(F.col("is_main"), F.pmod("hash", "p")).otherwise(F.col("p") + F.pmod("hash", "q")).cast("int")
    dealt = (
        met.join(main, "table").withColumns({"p": p, "q": q, "hash": F.xxhash64("node"), "is_main": F.col("component") == F.col("low")})
        .withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.when(F.col("is_main"), F.col("p")).otherwise(F.lit(0)), F.col("p") + F.col("q") - 1)))
        .select(
            "table", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "block", "i", "j", "node", "component"
        )
        .join(nodes.select("node", "n", "keys", "bitmap"), "node")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            rest = part if rest is None else pa.concat_tables([rest, part])
            # The last group may go on in the next batch.
            ends = _group_starts(rest)
            if len(ends) > 1:
                yield _close_pairs(rest.slice(0, ends[-1]), num, den)
                rest = rest.slice(ends[-1])
        if rest is not None and rest.num_rows:
            yield _close_pairs(rest, num, den)

    columns = ["table", "left", "right", "block", "i", "j", "node", "component", "n", "keys", "bitmap"]
    rows = dealt.select(*columns).repartition("table", "left", "right").sortWithinPartitions("table", "left", "right")
    return rows.mapInArrow(compare, "a long, b long").distinct()


def _group_starts(rows: pa.Table) -> np.ndarray:
    table, left, right = (rows.column(c).to_numpy() for c in ("table", "left", "right"))
    new = (table[1:] != table[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    return np.concatenate([[0], np.flatnonzero(new) + 1])


def _close_pairs(rows: pa.Table, num: int, den: int) -> pa.RecordBatch:
    """The pairs within each group that meet here first and may link."""
    columns = {c: rows.column(c).to_numpy() for c in ("left", "right", "block", "i", "j", "node", "component", "n")}
    keys = rows.column("keys").combine_chunks().flatten().to_numpy().reshape(-1, 2 * HALVES)
    maps = rows.column("bitmap").to_pylist()
    sizes = np.array([len(b) for b in maps])
    starts = _group_starts(rows)
    ends = np.repeat(np.append(starts[1:], rows.num_rows), np.diff(np.append(starts, rows.num_rows)))
    after = ends - np.arange(rows.num_rows) - 1
    done, found_a, found_b = np.concatenate([[0], np.cumsum(after)]), [], []
    at = 0
    while at < rows.num_rows:
        to = max(at + 1, int(np.searchsorted(done, done[at] + _PAIRS, "right")) - 1)
        x = np.repeat(np.arange(at, to), after[at:to])
        y = np.arange(len(x)) - np.repeat(done[at:to] - done[at], after[at:to]) + x + 1
        at = to
        n, c, block = columns["n"].astype(np.int64), columns["component"], columns["block"]
        # In the group of two blocks, pairs within one of them are left to that block's own group.
        keep = (c[x] != c[y]) & ((block[x] != block[y]) | (columns["left"][x] == columns["right"][x]))
        x, y = x[keep], y[keep]
        keep = den * np.minimum(n[x], n[y]) >= num * np.maximum(n[x], n[y])
        x, y = x[keep], y[keep]
        # The places of the first halves that agree are those of the first table in which the pair meets.
        same = keys[x] == keys[y]
        keep = (same[:, :HALVES].argmax(1) == columns["i"][x]) & (same[:, HALVES:].argmax(1) == columns["j"][x] - HALVES)
        x, y = x[keep], y[keep]
        least = np.minimum(sizes[x], sizes[y])
        for size in np.unique(least):
            px, py = x[least == size], y[least == size]
            used, back = np.unique(np.concatenate([px, py]), return_inverse=True)
            bits = np.stack([_folded(np.frombuffer(maps[r], np.uint8), size) for r in used]).view(np.uint64)
            for k in range(0, len(px), _PAIRS // 16):
                ax, ay = px[k : k + _PAIRS // 16], py[k : k + _PAIRS // 16]
                apart = np.bitwise_count(bits[back[: len(px)][k : k + len(ax)]] ^ bits[back[len(px) :][k : k + len(ax)]]).sum(axis=1, dtype=np.int64)
                ok = _may_link(n[ax], n[ay], apart, num, den)
                found_a.append(columns["node"][ax[ok]])
                found_b.append(columns["node"][ay[ok]])
    a = np.concatenate([*found_a, np.zeros(0, np.int64)])
    b = np.concatenate([*found_b, np.zeros(0, np.int64)])
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])


def minhash_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row; similarity ``num / den`` or more links.

    ``component_id`` is the smallest ``doc_id`` that links reach, the row's own included; that one is kept.
    """
    texts = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("mark"), F.col(f"`{text}`").alias("text")
    )
    sets = written(_sets(texts, width), "signed-sets")
    named = sets.where("n > 0 and doc_id is not null")
    nodes = written(
        named.groupBy("digest").agg(
            F.min(F.struct("doc_id", "mark")).alias("own"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("bitmap").alias("bitmap")
        ).select(F.monotonically_increasing_id().alias("node"), "digest", "own.doc_id", "own.mark", "n", "keys", "bitmap"),
        "nodes",
    )
    halves = nodes.select("node", F.posexplode("keys").alias("at", "key"))
    shared = halves.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key")
    half = F.struct("at", "key")
    keyed = written(
        halves.join(shared, "key").groupBy("node").agg(
            F.collect_list(F.when(F.col("at") < HALVES, half)).alias("first"), F.collect_list(F.when(F.col("at") >= HALVES, half)).alias("second")
        ),
        "shared-halves",
    )
    entries = _entries(keyed)
    least = entries.groupBy("table").agg(F.min("node").alias("b"), F.count("*").alias("size")).where("size > 1").select("table", "b")
    stars = written(entries.join(least, "table").where("node > b").groupBy(F.col("node").alias("a")).agg(F.min("b").alias("b")), "stars")
    known = [nodes, texts, width, num, den]
    links = written(_verified(stars, *known), "star-links")
    entries = None
    for turn in range(ROUNDS + 1):
        joined = connected_components(links)
        labelled = (entries if turn else keyed).join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
        if not turn:
            # From here on only tables in which several classes meet are read.
            entries = written(_open_entries(written(labelled, "labelled-halves")), "open-entries")
            labelled = entries.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
        labelled = written(labelled, "labelled-entries")
        turns = list(range(turn * TURNS, (turn + 1) * TURNS))
        pairs = written(_round_pairs(labelled, turns) if turn < ROUNDS else _open_pairs(labelled, nodes, num, den), "open-pairs")
        if pairs.isEmpty():
            break
        links = links.union(written(_verified(pairs, *known), "more-links"))

    own = nodes.select("node", "doc_id")
    linked = links.join(own.select(F.col("node").alias("a"), F.col("doc_id").alias("x")), "a").join(
        own.select(F.col("node").alias("b"), F.col("doc_id").alias("y")), "b"
    ).select(F.col("x").alias("a"), F.col("y").alias("b"))
    # An id with several texts ties their sets together.
    several = named.select("doc_id", "digest").distinct().withColumnRenamed("doc_id", "id")
    ids = several.groupBy("id").agg(F.count("*").alias("texts")).where("texts > 1").select("id")
    tied = several.join(ids, "id").join(nodes.select("digest", "doc_id"), "digest").select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    components = connected_components(linked.union(tied).where("a <> b"))
    classes = nodes.select("digest", "doc_id").join(
        components.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left"
    ).select("digest", F.coalesce("component", "doc_id").alias("component"))
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return sets.select("doc_id", "n", "digest").join(classes, "digest", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


ORACLE = r"""
    WITH RECURSIVE words AS (
      SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
      FROM documents),
    shingles AS (
      SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 2], ' ') END AS s, len(w) < 3 AS whole
      FROM words, unnest(range(1, greatest(len(w) - 1, 2))) r(i) WHERE len(w) > 0),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    links AS (
      SELECT a.doc_id AS a, b.doc_id AS b
      FROM shingles a JOIN shingles b ON a.s = b.s AND a.whole = b.whole AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id
      HAVING 100 * count(*) >= 85 * ((SELECT n FROM sizes WHERE doc_id = a.doc_id) + (SELECT n FROM sizes WHERE doc_id = b.doc_id) - count(*))),
    reach AS (
      SELECT doc_id, doc_id AS other FROM documents
      UNION
      SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
    SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
    FROM documents d LEFT JOIN sizes s USING (doc_id)
    JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)
"""
