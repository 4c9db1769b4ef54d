"""Merkle manifest of a dataset: a content-addressed graph of digests, and proofs read from it.

Rows are leaves.  In each group they ascend by their order column; every 8 nodes in a
row get a parent, until one is left, the group's root, and the groups' roots are joined
likewise into the root of the dataset.  The store keeps one record per distinct inner
node: its digest and its children's.

A proof is read by descent.  Leaf requests start at the root; the octal digits of a
leaf's rank say which child to go to, the other children make a segment of the path,
and the segments are reversed at the leaf.  Requests that share their first digits
share one row until they part, so a level is visited by as many rows as it has wanted
nodes, and no key is hot.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, div, materialize
from .ranks import ranked

BITS = 3
FAN = 1 << BITS

Levels = list[DataFrame]


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: ``-`` for null, else the value's bytes with their number and a colon before."""

    def part(field: Column) -> Column:
        value = field.cast("string")
        sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        return F.when(value.isNull(), F.lit("-")).otherwise(sized)

    return F.sha2(F.concat(*[part(f) for f in fields]), 256)


def node_digest(children: Column) -> Column:
    return F.sha2(F.array_join(children, ""), 256)


def upper(rank: Column, levels: int = 1) -> Column:
    """The rank of the node ``levels`` above."""
    return F.shiftright(rank, BITS * levels)


def grown(nodes: DataFrame, label: str) -> Levels:
    """All levels of all trees, from ``nodes`` up.

    A level is ``(tree, rank, n, digest, children)``; ``n`` is the number of nodes that
    the tree has on this level.  Trees of one node are complete and do not go on.
    """
    levels, most = [nodes], nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        nodes = levels[-1].where("n > 1")
        kids = F.sort_array(F.collect_list(F.struct(F.col("rank").alias("at"), "digest")))
        parents = nodes.groupBy("tree", upper(F.col("rank")).alias("rank")).agg(
            div(F.max("n") + (FAN - 1), F.lit(FAN)).alias("n"), kids["digest"].alias("children")
        )
        parents = parents.select("tree", "rank", "n", node_digest(F.col("children")).alias("digest"), "children")
        levels.append(materialize(parents, f"{label}-level"))
        most = -(-most // FAN)
    return levels


def tops(levels: Levels) -> DataFrame:
    """``(tree, height, digest)`` of the trees' roots."""
    found = [
        level.where("n = 1").select("tree", F.lit(height).alias("height"), "digest") for height, level in enumerate(levels)
    ]
    for other in found[1:]:
        found[0] = found[0].unionByName(other)
    return found[0]


def records(level: DataFrame) -> DataFrame:
    """The level's part of the store: distinct nodes, by digest."""
    return level.groupBy(F.col("digest").alias("of")).agg(F.first("children").alias("children"))


@dataclass(frozen=True)
class Manifest:
    """A dataset's tree.

    ``root``: its digest, None for an empty dataset.  ``leaves``: a leaf's row as the
    struct ``row``, with the number of its ``tree``, its ``rank`` there, the tree's size
    ``n`` and its ``digest``.  ``groups``: ``(tree, height, digest, name)``, ``name`` being
    the group's value.  ``leaf_levels`` and ``group_levels`` hold the records.
    """

    root: str | None
    leaves: DataFrame
    groups: DataFrame
    leaf_levels: Levels
    group_levels: Levels

    def store(self) -> DataFrame:
        """``(digest, children)`` of all distinct inner nodes."""
        inner = self.leaf_levels[1:] + self.group_levels[1:]
        found = self.leaves.sparkSession.createDataFrame([], "digest string, children array<string>")
        for level in inner:
            found = found.unionByName(level.select("digest", "children"))
        return found.groupBy("digest").agg(F.first("children").alias("children"))


def manifest(rows: DataFrame, group: str, order: str, leaf: str) -> Manifest:
    """The tree over ``rows``, whose column ``leaf`` holds their digests.

    Leaves ascend by ``order`` within ``group``, nulls first, ties by digest; groups
    ascend by the bytes of their text, null first.  Equal rows are leaves of their own.
    """
    named = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"),
        F.col(f"`{group}`").alias("name"), F.col(f"`{order}`").alias("by"), F.col(f"`{leaf}`").alias("digest"),
    )
    leaves = ranked(named, ["name"], ["by", "digest"], "merkle-leaves")
    leaves = materialize(leaves, "merkle-ranked")
    sizes = leaves.groupBy("name").agg(F.count("*").alias("n"))
    groups = ranked(sizes, [], ["name"], "merkle-groups").withColumnRenamed("rank", "tree")
    groups = materialize(groups, "merkle-trees")
    joined = leaves.join(groups.withColumnRenamed("name", "of"), F.col("name").eqNullSafe(F.col("of")))
    nodes = materialize(joined.select("row", "tree", "rank", "n", "digest"), "merkle-nodes")
    leaf_levels = grown(nodes.select("tree", "rank", "n", "digest"), "merkle-leaf")
    roots = materialize(tops(leaf_levels).join(groups.select("tree", "name"), "tree"), "merkle-roots")
    count = roots.count()
    group_nodes = roots.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), F.lit(count).cast("long").alias("n"), "digest"
    )
    group_levels = grown(group_nodes, "merkle-group")
    root = group_levels[-1].select("digest").first()
    return Manifest(root[0] if root else None, nodes, roots, leaf_levels, group_levels)


def descended(start: DataFrame, levels: Levels, wanted: Levels) -> DataFrame:
    """Go down from ``start`` to the nodes of ``wanted[0]``, collecting the children left aside.

    ``start`` is ``(tree, height, rank, digest, path)``: roots and the path above them.
    ``wanted[h]`` holds the distinct ``(tree, rank)`` asked for on level ``h``; at level 0
    its other columns are kept.  Returns them with the ``digest`` found and the ``path``:
    one struct of ``left`` and ``right`` siblings per level, from the root down.
    """
    here = start.where(F.col("height") == len(levels) - 1).drop("height")
    # Heights grow with the logarithm of a group.
    heights = {r[0] for r in start.select("height").distinct().collect()}
    for height in range(len(levels) - 2, -1, -1):
        found = here.join(records(levels[height + 1]), F.col("digest") == F.col("of"))
        found = found.select(F.col("tree").alias("in"), F.col("rank").alias("above"), "children", "path")
        below = wanted[height].join(found, (F.col("tree") == F.col("in")) & (upper(F.col("rank")) == F.col("above")))
        digit = F.col("rank").bitwiseAND(FAN - 1).cast("int")
        aside = F.struct(
            F.array_join(F.slice("children", F.lit(1), digit), "").alias("left"),
            F.array_join(F.slice("children", digit + 2, F.lit(FAN)), "").alias("right"),
        )
        here = below.select(
            *wanted[height].columns,
            F.get("children", digit).alias("digest"),
            F.concat("path", F.array(aside)).alias("path"),
        )
        if height in heights:
            # Trees whose root lies on this level join in.
            roots = start.where(F.col("height") == height).select(F.col("tree").alias("in"), "digest", "path")
            here = here.unionByName(wanted[height].join(roots, F.col("tree") == F.col("in")).drop("in"))
    return here


def prefixes(requests: DataFrame, height: int) -> Levels:
    """``requests`` and the distinct ``(tree, rank)`` above them, level by level."""
    wanted = [requests]
    for _ in range(height):
        above = wanted[-1].select("tree", upper(F.col("rank")).alias("rank")).distinct()
        wanted.append(materialize(above, "merkle-wanted"))
    return wanted


def proofs(tree: Manifest, requests: DataFrame) -> DataFrame:
    """Proofs of leaves, read from the store.

    ``requests`` has ``tree`` and ``rank`` of leaves, both long; its other columns are kept
    and must not be named ``digest``, ``subroot``, ``path``, ``in`` or ``above``.  Adds the
    leaf's ``digest``, its group's root as ``subroot`` and the ``path``: the siblings left
    and right of the way, one struct per level, from the leaf up.
    """
    # The one tree over the groups' roots, whose leaves are the groups.
    groups = tree.groups.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), "height")
    top = len(tree.group_levels) - 1
    start = tree.leaves.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("tree"), F.lit(top).alias("height"), F.lit(0).cast("long").alias("rank"),
        F.lit(tree.root).cast("string").alias("digest"),
        F.array().cast("array<struct<left:string,right:string>>").alias("path"),
    )
    if top:
        start = descended(start, tree.group_levels, prefixes(groups.withColumnRenamed("height", "depth"), top))
    else:
        start = start.select("tree", "digest", "path").join(groups.withColumnRenamed("height", "depth"), "tree")
    start = start.select(
        F.col("rank").alias("tree"), F.col("depth").alias("height"), F.lit(0).cast("long").alias("rank"), "digest", "path"
    )
    start = materialize(start, "merkle-starts")
    found = descended(start, tree.leaf_levels, prefixes(requests, len(tree.leaf_levels) - 1))
    if len(tree.leaf_levels) == 1:
        found = requests.join(found.select("tree", "digest", "path"), "tree")
    subroots = tree.groups.select(F.col("tree").alias("in"), F.col("digest").alias("subroot"))
    found = found.join(subroots, F.col("tree") == F.col("in")).drop("in")
    return found.withColumn("path", F.reverse("path"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of the siblings from the leaf up, left to right; of nothing for a lone leaf."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def document_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """``(doc_id, lang, leaf, altered)`` of the table ``documents``.

    ``altered`` is the digest after A-Z of the text were lower-cased, for ``tampered``
    rows; null for others.
    """
    fields = {c: F.col(c) for c in FIELDS}
    text = F.col("text").cast("string")
    altered = leaf_digest([*(fields | {"text": ascii_lower(text)}).values()])
    return docs.select(
        "doc_id", "lang", leaf_digest([*fields.values()]).alias("leaf"), F.when(tampered, altered).alias("altered")
    )


def verified_documents(docs: DataFrame) -> DataFrame:
    """Manifest of the table ``documents`` by language, and the verification of every row.

    A third of the rows, chosen by the CRC-32 of their ids, is verified with a tampered
    text.  Returns per row of ``docs``: ``doc_id``, ``leaf``, ``subroot``, ``root``,
    ``proof_sha256``, ``folded_root`` and ``verified``.

    * Nulls are digested as ``-``, unlike empty texts (``0:``).  Null languages make a
      group of their own, the first.  Rows without an id come first and are not tampered.
    * Repeated rows are leaves of their own, side by side; their ranks may be exchanged.
    * Other columns are not read.  An empty table gives an empty result.
    """
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tree = manifest(document_leaves(docs, tampered), "lang", "doc_id", "leaf")
    found = proofs(tree, tree.leaves.select("tree", "rank", "row.doc_id", "row.altered"))
    root = F.lit(tree.root).cast("string")
    found = found.withColumn("folded_root", folded(F.coalesce("altered", "digest"), F.col("path")))
    return found.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", root.alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == root).alias("verified"),
    )


def _levels_sql(name: str, key: str, first: str, levels: int) -> str:
    """CTEs ``name0`` to ``name<levels>`` of nodes; trees of one node stay as they are."""
    out = [f"{name}0 AS ({first})"]
    for k in range(levels):
        out.append(f"""{name}{k + 1} AS (
  SELECT {key}, rank // 8 AS rank, (max(n) + 7) // 8 AS n, max(n) AS below, list(digest ORDER BY rank) AS kids,
         CASE WHEN max(n) = 1 THEN max(digest) ELSE sha256(string_agg(digest, '' ORDER BY rank)) END AS digest
  FROM {name}{k} GROUP BY {key}, rank // 8)""")
    return ",\n".join(out)


def _fold_sql(name: str, key: str, first: str, levels: int, place: str) -> str:
    """CTEs that carry every leaf's ``proof`` and ``fold`` up the levels of ``name``."""
    out = [f"{name}p0 AS ({first})"]
    for k in range(levels):
        digit = f"(p.{place} >> {BITS * k}) % 8"
        left = f"array_to_string(t.kids[1:{digit}], '')"
        right = f"array_to_string(t.kids[{digit} + 2:], '')"
        out.append(f"""{name}p{k + 1} AS (
  SELECT p.* EXCLUDE (proof, fold),
         p.proof || CASE WHEN t.below = 1 THEN '' ELSE {left} || {right} END AS proof,
         CASE WHEN t.below = 1 THEN p.fold ELSE sha256({left} || p.fold || {right}) END AS fold
  FROM {name}p{k} p JOIN {name}{k + 1} t
    ON p.{key} IS NOT DISTINCT FROM t.{key} AND t.rank = p.{place} >> {BITS * (k + 1)})""")
    return ",\n".join(out)


def _leaf_sql(text: str) -> str:
    parts = [f"CAST({c} AS VARCHAR)" for c in FIELDS[:-1]] + [text]
    return "sha256(" + " || ".join(f"coalesce(strlen({p}) || ':' || {p}, '-')" for p in parts) + ")"


# CRC-32 of the decimal id, bit by bit.
_CRC_SQL = """xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
                           lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))))"""

# Enough levels for two million documents of a language and 512 languages.
_DEEP, _HIGH = 7, 3

ORACLE = f"""
WITH d AS (
  SELECT doc_id, lang, {_leaf_sql("text")} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {_CRC_SQL} % 3 = 0
              THEN {_leaf_sql(f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')")} END AS altered
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
         count(*) OVER (PARTITION BY lang) AS n
  FROM d),
{_levels_sql("t", "lang", "SELECT lang, rank, n, leaf AS digest FROM leaves", _DEEP)},
subroots AS (
  SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank, count(*) OVER () AS n, 0 AS one
  FROM t{_DEEP}),
{_levels_sql("g", "one", "SELECT one, rank, n, digest FROM subroots", _HIGH)},
{_fold_sql("t", "lang", "SELECT doc_id, lang, leaf, rank, '' AS proof, coalesce(altered, leaf) AS fold FROM leaves", _DEEP, "rank")},
{_fold_sql("g", "one", f"SELECT p.*, s.digest AS subroot, s.rank AS place, 0 AS one FROM tp{_DEEP} p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang", _HIGH, "place")}
SELECT p.doc_id, p.leaf, p.subroot, g.digest AS root, sha256(p.proof) AS proof_sha256, p.fold AS folded_root,
       p.fold = g.digest AS verified
FROM gp{_HIGH} p JOIN g{_HIGH} g ON g.rank = 0
"""
