"""A Merkle manifest of a table: one tree per group of rows, and one over the groups, by slot pivot.

Leaves are numbered by one range sort of narrow rows. Each level is one grouping by the number of the
parent: conditional aggregates spread its children into ``FANOUT`` slot columns. The concatenated
slots are hashed into the parent, and the slots without the own one are the siblings of a child, so
neither needs a list or a join of leaves. A level has a sixteenth of the rows of the one below;
proofs come down again by joins of parents with their parents, and the slots of the lowest level
give the leaves back. A group with most of the rows spreads like any other, since rows are dealt
by the number of their parent.

``H`` is lowercase hex SHA-256, and digests enter it as hex text. A field enters a leaf as its number
of UTF-8 bytes, a colon and its text, or ``-`` where it is null. Nulls of the order come first; equal
rows are leaves of their own; a run with one child is hashed like any other, but a tree with one leaf is
that leaf. Columns of other names are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.positions import row_position
from corpusloom.session import written

# Children of a node.
FANOUT = 16

_SLOTS = [f"s{i}" for i in range(FANOUT)]


def H(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """How a value enters a leaf."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return H(*map(field, values))


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else."""
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.translate(text, upper, upper.lower())


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf and its siblings, level by level, lead to."""
    return F.aggregate(path, digest, lambda h, run: H(run["left"], h, run["right"]))


def proof_digest(path: Column) -> Column:
    """``H`` of all siblings of a path."""
    return F.sha2(F.array_join(F.transform(path, lambda run: F.concat(run["left"], run["right"])), ""), 256)


def _digests(slots: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(f"{s}.digest"), F.lit("")) for s in slots]


def _run(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return F.struct(F.concat(F.lit(""), *left).alias("left"), F.concat(F.lit(""), *right).alias("right"))


def _parents(nodes: DataFrame) -> DataFrame:
    """``tree, pos, n, digest`` and the slots, of the parents of ``tree, pos, n, kid``."""
    slot = F.col("pos") % FANOUT
    spread = [F.max(F.when(slot == i, F.col("kid"))).alias(s) for i, s in enumerate(_SLOTS)]
    parents = nodes.where("n > 1").groupBy("tree", F.expr(f"pos div {FANOUT}").alias("pos"), "n").agg(*spread)
    return parents.withColumn("digest", H(*_digests(_SLOTS))).withColumn("n", F.expr(f"(n + {FANOUT - 1}) div {FANOUT}"))


def _levels(nodes: DataFrame, most: int) -> list[DataFrame]:
    """The parents of each level up to the roots of trees with at most ``most`` leaves."""
    levels: list[DataFrame] = []
    while most > 1 or not levels:
        levels.append(written(_parents(nodes), "merkle-level"))
        nodes = levels[-1].select("tree", "pos", "n", F.struct("digest").alias("kid"))
        most = -(-most // FANOUT)
    return levels


def _tops(nodes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``tree, digest`` of each tree's root."""
    found = [level.where("n = 1").select("tree", "digest") for level in levels]
    return reduce(DataFrame.union, found, nodes.where("n = 1").select("tree", "kid.digest"))


def _down(nodes: DataFrame, levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``kid, path`` of every leaf, with the other columns of ``tops`` (``tree, path, ...``)."""
    named = [c for c in tops.columns if c not in ("tree", "path")]
    kept = ["tree", "pos", *_SLOTS, "path", *named]
    above = None
    for level in reversed(levels):
        now = level.where("n = 1").join(tops, "tree").select(*kept)
        if above is not None:
            slot = F.col("pos") % FANOUT
            ups = [f"u{i}" for i in range(FANOUT)]
            digests = _digests(ups)
            run = _run(
                [F.when(slot > i, d).otherwise("") for i, d in enumerate(digests)],
                [F.when(slot < i, d).otherwise("") for i, d in enumerate(digests)],
            )
            up = above.select("tree", F.col("pos").alias("up"), *[F.col(s).alias(u) for s, u in zip(_SLOTS, ups)], "path", *named)
            inner = level.where("n > 1").withColumn("up", F.expr(f"pos div {FANOUT}")).join(up, ["tree", "up"])
            now = now.union(inner.withColumn("path", F.concat(F.array(run), F.col("path"))).select(*kept))
        above = now
    digests = _digests(_SLOTS)
    kids = F.array(*[F.struct(F.col(s).alias("kid"), _run(digests[:i], digests[i + 1 :]).alias("run")) for i, s in enumerate(_SLOTS)])
    spread = above.select(F.explode(F.filter(kids, lambda k: k["kid"].isNotNull())).alias("k"), "path", *named)
    leaves = spread.select("k.kid", F.concat(F.array("k.run"), F.col("path")).alias("path"), *named)
    return leaves.union(nodes.where("n = 1").join(tops, "tree").select("kid", "path", *named))


def merkle_manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "source",
    order: str = "doc_id",
    carried: Callable[[Callable[[str], Column]], dict[str, Column]] = lambda column: {},
) -> DataFrame:
    """``doc_id, source`` (the order and the group), ``leaf, path, subroot, root`` of every row.

    ``path`` lists from the lowest level up the siblings before and after the own node, each as
    concatenated digests. ``carried`` names more columns to compute where a row is read, from
    a function that gives its columns; digests of texts, not texts, should be carried.
    """
    column = lambda name: F.col(f"`{name}`")
    more = carried(column)
    leaves = written(
        docs.select(
            column(order).cast("long").alias("order"), column(group).cast("string").alias("group"),
            leaf_digest(*map(column, fields)).alias("digest"), *[c.alias(f"more_{n}") for n, c in more.items()],
        ),
        "merkle-leaves",
    )
    # Equal groups and orders are told apart by their digests; leaves with equal digests are alike.
    placed = row_position(leaves, ["group", "order", "digest"], "at")
    groups = written(placed.groupBy("group").agg(F.min("at").alias("tree"), F.count("*").alias("n")), "merkle-groups")
    most, sources = groups.agg(F.coalesce(F.max("n"), F.lit(0)), F.count("*")).first()
    there = groups.withColumnRenamed("group", "own_group")
    nodes = placed.join(there, F.col("group").eqNullSafe(F.col("own_group"))).select(
        "tree", (F.col("at") - F.col("tree")).alias("pos"), "n",
        F.struct("digest", "order", "group", *[f"more_{n}" for n in more]).alias("kid"),
    )
    levels = _levels(nodes, most)

    # A tree is named by the number of its first leaf, so trees follow the order of their groups.
    subroots = row_position(_tops(nodes, levels), "tree", "pos")
    top = subroots.select(
        F.lit(0).cast("long").alias("tree"), "pos", F.lit(sources).cast("long").alias("n"), F.struct("digest", F.col("tree").alias("of")).alias("kid")
    )
    top_levels = _levels(top, sources)
    above = _tops(top, top_levels).select(
        "tree", F.array().cast("array<struct<left: string, right: string>>").alias("path"), F.col("digest").alias("root")
    )
    tops = _down(top, top_levels, above).select(
        F.col("kid.of").alias("tree"), "path", F.col("kid.digest").alias("subroot"), "root"
    )
    found = _down(nodes, levels, written(tops, "merkle-subroots"))
    return found.select(
        F.col("kid.order").alias(order), F.col("kid.group").alias(group), F.col("kid.digest").alias("leaf"), "path", "subroot", "root",
        *[F.col(f"kid.more_{n}").alias(n) for n in more],
    )


def tamper_report(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents``, and whether each row still folds to the root.

    Of the rows whose ``doc_id`` has a CRC-32 that five divides, the text is lower-cased first.
    """

    def tampered(column):
        chosen = F.crc32(column("doc_id").cast("string")) % 5 == 0
        changed = leaf_digest(column("doc_id"), column("source"), column("lang"), column("n_chars"), ascii_lower(column("text")))
        return {"tampered": F.when(chosen, changed)}

    found = merkle_manifest(docs, carried=tampered)
    root = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), root.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLE = """
    WITH RECURSIVE crc_table AS (
      SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) r(i))),
    own AS (
      SELECT d.*, CAST(doc_id AS VARCHAR) AS digits, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos,
        count(*) OVER (PARTITION BY source) AS n,
        xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
          lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 5 = 0 AS chosen
      FROM documents d, crc_table),
    fields AS (
      SELECT *, coalesce(octet_length(encode(digits)) || ':' || digits, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
          || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
        octet_length(encode(text)) || ':' AS bytes
      FROM own),
    leaves AS (
      SELECT doc_id, source, pos, n, sha256(head || coalesce(bytes || text, '-')) AS leaf,
        CASE WHEN chosen THEN sha256(head || coalesce(bytes || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS tampered
      FROM fields),
    tree AS (
      SELECT 0 AS level, source, pos, n, leaf AS digest FROM leaves
      UNION ALL
      SELECT level + 1, source, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
      FROM tree WHERE n > 1 GROUP BY level, source, pos // 16, n),
    subroots AS (SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
    top AS (
      SELECT 0 AS level, pos, n, subroot AS digest FROM subroots
      UNION ALL
      SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 16, n),
    runs AS (
      SELECT 0 AS part, level, source, pos, string_agg(digest, '') OVER (PARTITION BY source, level, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
        string_agg(digest, '') OVER (PARTITION BY source, level, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r
      FROM tree WHERE n > 1
      UNION ALL
      SELECT 1, level, NULL, pos, string_agg(digest, '') OVER (PARTITION BY level, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
        string_agg(digest, '') OVER (PARTITION BY level, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
      FROM top WHERE n > 1),
    steps AS (
      SELECT x.source, x.pos AS leaf_pos, r.part, r.level, coalesce(r.l, '') AS l, coalesce(r.r, '') AS r
      FROM leaves x JOIN runs r ON r.part = 0 AND r.source IS NOT DISTINCT FROM x.source AND r.pos = x.pos // CAST(power(16, r.level) AS BIGINT)
      UNION ALL
      SELECT x.source, x.pos, r.part, r.level, coalesce(r.l, ''), coalesce(r.r, '')
      FROM leaves x JOIN subroots s ON s.source IS NOT DISTINCT FROM x.source
      JOIN runs r ON r.part = 1 AND r.pos = s.pos // CAST(power(16, r.level) AS BIGINT)),
    paths AS (
      SELECT source, leaf_pos, list({'l': l, 'r': r} ORDER BY part, level) AS path, string_agg(l || r, '' ORDER BY part, level) AS siblings
      FROM steps GROUP BY source, leaf_pos),
    found AS (
      SELECT x.doc_id, x.leaf, s.subroot, (SELECT digest FROM top WHERE n = 1) AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
        list_reduce(list_concat([{'l': '', 'r': coalesce(x.tampered, x.leaf)}], coalesce(p.path, [])),
          lambda a, b: {'l': '', 'r': sha256(b.l || a.r || b.r)}).r AS folded_root
      FROM leaves x JOIN subroots s ON s.source IS NOT DISTINCT FROM x.source
      LEFT JOIN paths p ON p.source IS NOT DISTINCT FROM x.source AND p.leaf_pos = x.pos)
    SELECT *, folded_root = root AS verified FROM found
"""
