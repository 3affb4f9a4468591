"""A Merkle manifest of a table, its nodes hashed by a slot pivot.

Rows are leaves, numbered in each group (a source) by order columns, nulls first. Of every
``fanout`` consecutive nodes the digests are spread into one row of slot columns by
conditional aggregates. The slots behind one another hash to the parent; without the own
slot, those in front and behind are a child's siblings. Levels are stored one by one, each a
``fanout``-th of the one below, until every group has one node left. The groups' nodes,
ordered by group, are the leaves of a last tree, whose top is the root.

Proofs go down again: each pivoted row meets its parent's path, and its children add their
siblings to it. A path is what a leaf needs to compute the root: per level, the digests left
and right of the node that it lies in. No group is in one task: places come from range
partitions, and a pivoted row depends on ``fanout`` nodes.

Null fields hash as ``-``, others with their length, so null and empty differ, and texts of
any length are hashed whole. Repeated rows are leaves of their own, side by side. Rows
without order value come first in their group. An empty table has no root and no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.llm.places import join_pieces, ranked, sorted_parts, unrolled
from loomframe.llm.shared import only, stored

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Of the rows whose id's checksum this divides, the query changes the text.
TAMPERED = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*values: Column) -> Column:
    """Hash of texts behind one another."""
    return F.sha2(F.concat(*values), 256)


def field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def siblings(path: Column) -> Column:
    """All digests of a path, left to right and level by level."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda below, step: digest(step["left"], below, step["right"]))


@dataclass
class Tree:
    """``levels``: pivoted rows, lowest first; ``tops``: tree, level and digest of each tree's last node."""

    levels: list[DataFrame]
    tops: DataFrame
    fanout: int


@dataclass
class Manifest:
    """``groups`` has each group's digest; ``leaves`` the kept columns, leaf, digest and path."""

    root: str | None
    groups: DataFrame
    leaves: DataFrame


def grow(nodes: DataFrame, largest: int, fanout: int) -> Tree:
    """Pivot nodes (tree, at, size, item with a digest) until each tree has one left."""
    levels, tops = [], []
    while largest > 1 or not levels:
        levels.append(stored(nodes.groupBy("tree", F.floor(F.col("at") / fanout).alias("at")).agg(
            F.max("size").alias("size"),
            *[F.expr(f"max(CASE WHEN at % {fanout} = {k} THEN item END) AS slot{k}") for k in range(fanout)])))
        # The only node of a tree is its top as it is.
        joined = F.when(F.col("size") == 1, F.col("slot0.digest")).otherwise(
            digest(F.expr("concat({})".format(", ".join(f"coalesce(slot{k}.digest, '')" for k in range(fanout))))))
        above = levels[-1].select("tree", "at", F.ceil(F.col("size") / fanout).alias("size"),
                                  F.struct(joined.alias("digest")).alias("item"))
        tops.append(above.filter("size = 1").select("tree", F.lit(len(levels)).alias("level"),
                                                    F.col("item.digest").alias("digest")))
        nodes = above.filter("size > 1")
        largest = -(-largest // fanout)
    whole = tops[0]
    for more in tops[1:]:
        whole = whole.unionByName(more)
    return Tree(levels, whole, fanout)


def descend(tree: Tree, tops: DataFrame) -> DataFrame:
    """tree, at, item, top and path of every leaf; ``tops`` has each tree's level, top and path."""
    n, parents = tree.fanout, None
    for level in range(len(tree.levels), 0, -1):
        ended = tops.filter(F.col("level") == level).select("tree", F.lit(0).cast("long").alias("at"), "top", "path")
        parents = ended if parents is None else parents.drop("item").unionByName(ended)
        slots = [f"coalesce(slot{k}.digest, '')" for k in range(n)]
        children = F.expr("array({})".format(", ".join(
            "named_struct('at', at * {} + {}, 'item', slot{}, 'left', concat({}), 'right', concat({}))".format(
                n, k, k, ", ".join(["''", *slots[:k]]), ", ".join(["''", *slots[k + 1:]])) for k in range(n))))
        step = F.array(F.struct(F.col("child.left").alias("left"), F.col("child.right").alias("right")))
        parents = tree.levels[level - 1].join(parents, ["tree", "at"]).select(
            "tree", "size", "top", "path", F.explode(children).alias("child")).filter("child.item IS NOT NULL") \
            .select("tree", F.col("child.at").alias("at"), F.col("child.item").alias("item"), "top",
                    F.when(F.col("size") == 1, F.col("path")).otherwise(F.concat(step, "path")).alias("path"))
    return parents


_PATH = "array<struct<left:string,right:string>>"


def manifest(rows: DataFrame, group: str, order: list[str], fanout: int = FANOUT) -> Manifest:
    """The manifest of rows with a column ``leaf``; all other columns come back with it.

    Rows are ordered by the order columns and then by all others.
    """
    kept = rows.columns
    rest = [c for c in kept if c != group and c not in order]
    ranged, pieces = sorted_parts(unrolled(rows, *kept), [group], [*order, *rest, "copy"])
    groups = pieces.groupBy(group).agg(F.max("size").alias("leaves"))
    numbered = stored(ranked(groups, group).select(
        F.col(group).alias("_group"), "leaves", F.col("places").alias("groups"), F.col("place").alias("tree")))
    largest, count = numbered.agg(F.max("leaves"), F.max("groups")).first()
    if not count:
        empty = rows.select(*kept, F.lit("").alias("top"), F.array().cast(_PATH).alias("path")).filter("false")
        return Manifest(None, empty.select(group, F.lit("").alias("digest")), empty)
    placed = join_pieces(ranged, pieces.join(numbered, pieces[group].eqNullSafe(numbered["_group"])).select(
        pieces["part"], pieces[group], "tree", "shift", "size"), [group])
    low = grow(placed.select("tree", (F.col("at") + F.col("shift")).alias("at"), "size", F.struct(
        F.col("leaf").alias("digest"), *[c for c in kept if c != "leaf"]).alias("item")), largest, fanout)
    low.tops = stored(low.tops)
    high = grow(low.tops.join(numbered, "tree").select(
        F.lit(0).alias("tree"), F.col("tree").alias("at"), F.col("groups").alias("size"),
        F.struct("digest", "level").alias("item")), count, fanout)
    root = high.tops.first()["digest"]
    tops = descend(high, high.tops.select("tree", "level", F.lit(root).alias("top"), F.array().cast(_PATH).alias("path"))) \
        .select(F.col("at").alias("tree"), F.col("item.level").alias("level"),
                F.col("item.digest").alias("top"), "path")
    leaves = descend(low, stored(tops)).select(
        *[F.col("item.digest" if c == "leaf" else f"item.`{c}`").alias(c) for c in kept], "top", "path")
    by_group = low.tops.join(numbered, "tree").select(F.col("_group").alias(group), "digest")
    return Manifest(root, by_group, leaves)


def verify(docs: DataFrame, tampered: int = TAMPERED, fanout: int = FANOUT) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether a changed copy verifies.

    The change lower-cases A-Z where ``tampered`` divides the id's checksum, so texts without
    such letters, null ones, and rows without id stay as they are and verify.
    """
    own = only(docs, **{c: c for c in FIELDS})
    checked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % tampered == 0
    lowered = leaf(*[F.translate(c, _UPPER, _LOWER) if c == "text" else F.col(c) for c in FIELDS])
    rows = own.select("doc_id", "source", leaf(*[F.col(c) for c in FIELDS]).alias("leaf"),
                      F.when(checked, lowered).alias("changed"))
    made = manifest(rows, "source", ["doc_id"], fanout)
    folded = fold(F.coalesce("changed", "leaf"), F.col("path"))
    root = F.lit(made.root).cast("string")
    return made.leaves.select(
        "doc_id", "leaf", F.col("top").alias("subroot"), root.alias("root"),
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), folded.alias("folded_root"),
        (folded == root).alias("verified"))


#: The same in DuckDB. The checksum goes bit by bit, the trees level by level.
SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, concat(
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
        coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
    text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
    list_transform(range(8 * length(doc_id::VARCHAR)), lambda j: CASE WHEN j % 8 = 0
        THEN ascii(substr(doc_id::VARCHAR, (j // 8 + 1)::INT, 1)) ELSE 0 END::BIGINT) AS bits FROM documents),
e AS (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN doc_id IS NOT NULL AND xor(list_reduce(list_prepend(4294967295::BIGINT, bits), lambda c, b:
        xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295) % 5 = 0
        THEN sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-')) END AS changed FROM d),
l AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM e),
low(tree, level, pos, n, digest) AS (SELECT tree, 0, pos, n, leaf FROM l UNION ALL
    SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
    FROM low WHERE n > 1 GROUP BY tree, level, pos // 16, n),
high(level, pos, n, digest) AS (SELECT 0, tree, count(*) OVER (), digest FROM low WHERE n = 1 UNION ALL
    SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
    FROM high WHERE n > 1 GROUP BY level, pos // 16, n),
steps AS (SELECT tree, level, pos, coalesce(string_agg(digest, '') OVER f, '') AS l, coalesce(string_agg(digest, '') OVER b, '') AS r
    FROM (SELECT * FROM low UNION ALL SELECT -1, level, pos, n, digest FROM high) WHERE n > 1
    WINDOW f AS (PARTITION BY tree, level, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    b AS (PARTITION BY tree, level, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
paths AS (SELECT l.tree, l.pos, list({'l': s.l, 'r': s.r} ORDER BY s.tree < 0, s.level) FILTER (s.tree IS NOT NULL) AS path
    FROM l LEFT JOIN steps s ON s.tree = l.tree AND s.pos = l.pos // (16 ** s.level)::BIGINT
        OR s.tree = -1 AND s.pos = l.tree // (16 ** s.level)::BIGINT GROUP BY l.tree, l.pos),
f AS (SELECT doc_id, l.leaf, low.digest AS subroot, (SELECT digest FROM high WHERE n = 1) AS root,
    sha256(coalesce(list_aggregate(list_transform(path, lambda s: s.l || s.r), 'string_agg', ''), '')) AS proof_sha256,
    list_reduce(list_prepend({'l': coalesce(changed, leaf), 'r': ''}, coalesce(path, [])), lambda a, s:
        {'l': sha256(s.l || a.l || s.r), 'r': ''}).l AS folded_root
    FROM l JOIN paths USING (tree, pos) JOIN low ON low.tree = l.tree AND low.n = 1)
SELECT *, folded_root = root AS verified FROM f
"""
