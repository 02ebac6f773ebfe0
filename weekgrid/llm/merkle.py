"""Merkle manifest of a dataset, with a proof for every row.

Leaves are numbered within their group and cut into superblocks of ``2 ** LEVELS``.
On the way up a superblock becomes one node, until one node per group is left; the
groups' nodes are reduced in the same way. On the way down each superblock meets
its outer nodes, the siblings above it, in a cogroup: there its own tree is built
again, every member's proof is joined from inner and outer siblings, and the proof
is folded. No superblock has more than ``2 ** LEVELS`` rows, whatever its group has.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weekgrid.llm.common import stored, table, tidy
from weekgrid.llm.order import ranked

LEVELS = 10
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
NODE = "lang string, rank long, node string, size long"
PATH = "lang string, rank long, path string, subroot string, root string"
PROOF = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def row_hash(values: list[Column]) -> Column:
    """Of each value its byte count, a colon and its text, or ``-`` for a null."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def levels_of(size: int, levels: int) -> int:
    """How many levels of a group of ``size`` nodes lie in a superblock."""
    return min(levels, (size - 1).bit_length())


def tree(nodes: list[str], height: int) -> list[list[str]]:
    """The nodes of a superblock, level by level; a node without a neighbour is hashed alone."""
    levels = [nodes]
    for _ in range(height):
        last = levels[-1]
        levels.append([digest("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return levels


def steps(levels: list[list[str]], i: int) -> list[str]:
    """The way up from node ``i``: per level ``R`` or ``L`` (the sibling's side) and the sibling, or ``-``."""
    way = []
    for nodes in levels[:-1]:
        other = i ^ 1
        way.append(("R" if other > i else "L") + nodes[other] if other < len(nodes) else "-")
        i >>= 1
    return way


def fold(node: str, way: list[str]) -> str:
    """The root that a node and the siblings on its way give."""
    for step in way:
        node = digest(node + step[1:] if step[0] == "R" else step[1:] + node if step[0] == "L" else node)
    return node


def block(levels: int) -> Column:
    return F.shiftright("rank", levels)


def climb(nodes: DataFrame, levels: int, name: str) -> list[DataFrame]:
    """The given nodes (lang, rank, node, size), then one node per superblock, and so on
    up to one node per group; each level is a stored table."""

    def reduce(key, rows):
        rows = rows.sort_values("rank")
        size = int(rows["size"].iloc[0])
        top = tree(rows["node"].tolist(), levels_of(size, levels))[-1]
        return pd.DataFrame({"lang": [key[0]], "rank": [int(key[1])], "node": top, "size": [-(-size // (1 << levels))]})

    found = [nodes]
    while found[-1].where("size > 1").limit(1).count():
        # A group's key is null-safe in a grouping; its superblocks are bounded groups.
        found.append(stored(found[-1].groupBy("lang", block(levels).alias("b")).applyInPandas(reduce, NODE), name))
    return found


def descend(nodes: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """Ways of the nodes of one level, given the ways (``PATH``) of the level above."""

    def join(key, inner, above):
        inner = inner.sort_values("rank")
        names = inner["node"].tolist()
        held = tree(names, levels_of(int(inner["size"].iloc[0]), levels))
        top = above.iloc[0]
        ways = [",".join(x for x in (*steps(held, i), top["path"]) if x) for i in range(len(names))]
        return pd.DataFrame({
            "lang": [key[0]] * len(names), "rank": inner["rank"].tolist(), "path": ways, "subroot": top["subroot"], "root": top["root"],
        })

    return nodes.groupBy("lang", block(levels).alias("b")).cogroup(outer.groupBy("lang", "rank")).applyInPandas(join, PATH)


def prove(leaves: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """The last exchange: leaves and the outer nodes of their superblock."""

    def finish(key, inner, above):
        inner = inner.sort_values("rank")
        names = inner["node"].tolist()
        held = tree(names, levels_of(int(inner["size"].iloc[0]), levels))
        top = above.iloc[0]
        beyond = top["path"].split(",") if top["path"] else []
        proofs, folded = [], []
        for i, (leaf, tampered) in enumerate(zip(names, inner["tampered"].tolist())):
            way = steps(held, i) + beyond
            proofs.append(digest("".join(s[1:] for s in way)))
            folded.append(fold(tampered if isinstance(tampered, str) else leaf, way))
        return pd.DataFrame({
            "doc_id": inner["doc_id"].tolist(), "leaf": names, "subroot": top["subroot"], "root": top["root"],
            "proof_sha256": proofs, "folded_root": folded,
        })

    return leaves.groupBy("lang", block(levels).alias("b")).cogroup(outer.groupBy("lang", "rank")).applyInPandas(finish, PROOF)


@tidy
def manifest(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Roots and proofs of leaves (doc_id long, lang string, leaf string, tampered string).

    One row per leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.
    Within a ``lang`` (null is one, the first) leaves ascend by doc_id, null first; rows
    with one doc_id follow each other by leaf, and equal leaves are told apart by an
    arbitrary number, which changes no set of results. ``tampered`` is the leaf to fold
    in place of the original, or null. A group of one leaf is its own subroot; its
    proof starts with the siblings of the subroot. A dataset of one leaf has an empty
    proof. An empty table gives no rows.
    """
    rows = leaves.select(
        "lang", F.col("doc_id").cast("long").alias("doc_id"), F.col("leaf").alias("node"), "tampered",
        F.monotonically_increasing_id().alias("row"),
    )
    placed = stored(ranked(stored(rows, "leaves"), ["lang"], ["doc_id", "node", "row"], "sorted").drop("row"), "ranked")
    inner = climb(placed.select("lang", "rank", "node", "size"), levels, "nodes")
    subroots = inner[-1].select(F.lit(0).alias("one"), "lang", F.col("node").alias("subroot"))
    named = stored(ranked(subroots, ["one"], ["lang"], "subroots"), "forest")
    upper = climb(named.select(F.lit(None).cast("string").alias("lang"), "rank", F.col("subroot").alias("node"), "size"), levels, "tops")
    top = upper[-1].select("lang", "rank", F.lit("").alias("path"), F.lit("").alias("subroot"), F.col("node").alias("root"))
    for nodes in reversed(upper[:-1]):
        top = stored(descend(nodes, top, levels), "ways")
    # A subroot's way is that of its group's highest node.
    way = named.drop("subroot").join(top.select("rank", "path", "root"), "rank").join(
        inner[-1].select(F.col("lang").alias("of"), F.col("node").alias("subroot")), F.col("lang").eqNullSafe(F.col("of"))
    ).select("lang", F.lit(0).cast("long").alias("rank"), "path", "subroot", "root")
    for nodes in reversed(inner[1:-1]):
        way = stored(descend(nodes, way, levels), "ways")
    # Ids travel as text, as pandas would round those of a column with nulls.
    proofs = prove(placed.withColumn("doc_id", F.col("doc_id").cast("string")), way, levels)
    return proofs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def document_leaves(docs: DataFrame, every: int = 7) -> DataFrame:
    """Leaves of documents. Where ``every`` divides the crc32 of the id's text, the
    tampered leaf has one character more in ``n_chars``; a null stays, and a row
    without an id is left alone."""
    chars = F.col("n_chars").cast("decimal(20,0)")
    values = {c: F.col(c) for c in FIELDS} | {"n_chars": chars, "doc_id": F.col("doc_id").cast("long")}
    changed = values | {"n_chars": (chars + 1).cast("decimal(20,0)")}
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        row_hash(list(values.values())).alias("leaf"), F.when(picked, row_hash(list(changed.values()))).alias("tampered"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(document_leaves(table(spark, sf_dir, "documents")))


# An id's crc32 bit by bit; trees and folds level by level.
ORACLE_SQL = """
WITH RECURSIVE texts AS (
  SELECT doc_id, lang, n_chars,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS tail,
         list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [CAST(b AS BIGINT) for b in range(8)]),
             lambda r, bit: xor(r >> 1, (r & 1) * 3988292384))) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
         CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN
           sha256(head || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) END AS tampered
  FROM texts),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS c
  FROM leaves),
inner_nodes AS (
  SELECT 0 AS level, lang, i, leaf AS node, c FROM placed
  UNION ALL
  SELECT level + 1, lang, i // 2, sha256(string_agg(node, '' ORDER BY i)), (c + 1) // 2
  FROM inner_nodes WHERE c > 1 GROUP BY level, lang, i // 2, c),
subroots AS (
  SELECT lang, level AS height, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS c
  FROM inner_nodes WHERE c = 1),
outer_nodes AS (
  SELECT 0 AS level, i, subroot AS node, c FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, sha256(string_agg(node, '' ORDER BY i)), (c + 1) // 2
  FROM outer_nodes WHERE c > 1 GROUP BY level, i // 2, c),
root AS (SELECT level AS top, node AS root FROM outer_nodes WHERE c = 1),
members AS (
  SELECT p.*, s.height, s.subroot, s.i AS place, r.root, r.top, row_number() OVER () AS row
  FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang, root r),
walk AS (
  SELECT row, 0 AS step, coalesce(tampered, leaf) AS folded, '' AS proof FROM members
  UNION ALL
  SELECT w.row, w.step + 1,
         sha256(CASE WHEN n.i IS NOT NULL AND n.i % 2 = 0 THEN n.node ELSE '' END || w.folded
                || CASE WHEN n.i % 2 = 1 THEN n.node ELSE '' END),
         w.proof || coalesce(n.node, '')
  FROM walk w JOIN members m ON w.row = m.row AND w.step < m.height + m.top
  LEFT JOIN (SELECT true AS within, lang, level, i, node FROM inner_nodes
             UNION ALL SELECT false, NULL, level, i, node FROM outer_nodes) n
    ON n.within = (w.step < m.height)
   AND n.lang IS NOT DISTINCT FROM CASE WHEN w.step < m.height THEN m.lang END
   AND n.level = CASE WHEN w.step < m.height THEN w.step ELSE w.step - m.height END
   AND n.i = CASE WHEN w.step < m.height THEN xor(m.i >> w.step, 1) ELSE xor(m.place >> (w.step - m.height), 1) END)
SELECT m.doc_id, m.leaf, m.subroot, m.root, sha256(w.proof) AS proof_sha256, w.folded AS folded_root, w.folded = m.root AS verified
FROM members m JOIN walk w ON m.row = w.row AND w.step = m.height + m.top
"""
