"""Merkle manifest of a dataset: checkpoint and recompute (DataFrame operations only).

Rows are leaves. The leaves of a group, in the order of their ids, are the bottom of a binary tree; the trees'
roots (subroots) are the leaves of one tree above. Only every ``step``-th level is stored. What
stands between is made anew wherever it is needed: a stored node's subtree of ``step`` levels is aligned, so its
2**step stored descendants at most, gathered by their block number, give every node inside. The build keeps the
top of each block and forgets the rest; the proofs regenerate a block's levels once more, give each child the
siblings on its way up, and forget the rest again.

Places in a tree come from a range exchange in the order of (group, id, leaf), so a group however large is dealt
over all tasks; a block has 2**step rows at most; siblings above a block come down by a join of one row per block.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, load, numbered

#: Levels of a block: one level in so many is stored.
STEP = 6
#: The columns of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the values: ``-`` for a null, else UTF-8 byte count, colon, value."""

    def told(value):
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(told, values)), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path stand for. path: array of (d: sibling or null where a node is alone, left: whether it stands left)."""

    def step(own, s):
        return F.sha2(F.when(s["d"].isNull(), own).when(s["left"], F.concat(s["d"], own)).otherwise(F.concat(own, s["d"])), 256)

    return F.aggregate(path, leaf, step)


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with the value computed once; an expression named in a lambda would be computed for every element."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _height(n: Column) -> Column:
    """Levels above n nodes until one is left."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _blocks(level: DataFrame, step: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """(tree, block, n, c: its nodes in order) of the aligned subtrees over a stored level."""
    node = F.struct("pos", F.lower(F.hex("digest")).alias("d"), *carry)
    return level.groupBy("tree", F.shiftright("pos", step).alias("block")).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(node)).alias("c"))


def _levels(step: int) -> Column:
    """All levels of a block, from its stored nodes to its top, as an array of arrays of hex digests."""

    def up(nodes):
        pairs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int"))
        return F.transform(pairs, lambda i: F.sha2(F.concat(F.get(nodes, i * 2), F.coalesce(F.get(nodes, i * 2 + 1), F.lit(""))), 256))

    rounds = F.slice(F.array(*map(F.lit, range(step))), F.lit(1), F.least(F.lit(step), _height(F.col("n"))))
    return F.aggregate(rounds, F.array(F.col("c.d")), lambda made, _: F.array_append(made, up(F.element_at(made, -1))))


def _build(scratch: Scratch, nodes: DataFrame, step: int, name: str) -> list[DataFrame]:
    """The stored levels (tree, pos, n, digest) from ``nodes`` up to the one that has one node a tree."""
    levels = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 1
    while most > 1:
        top = F.unhex(F.element_at(F.element_at(_levels(step), -1), 1))
        made = _blocks(levels[-1], step).select("tree", F.col("block").alias("pos"), (F.shiftright(F.col("n") - 1, step) + 1).alias("n"), top.alias("digest"))
        levels.append(scratch.write(made, f"{name}{len(levels)}"))
        most = ((most - 1) >> step) + 1
    return levels


def _paths(levels: list[DataFrame], tops: DataFrame, step: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """(tree, pos, d, path, the other columns of ``tops``, carry) of every node of the lowest level. tops: (tree, path, ...), the path above each tree."""
    above = tops.withColumn("pos", F.lit(0).cast("long"))
    more = [c for c in tops.columns if c not in ("tree", "path")]
    if len(levels) == 1:
        return above.join(levels[0].select("tree", F.lower(F.hex("digest")).alias("d"), *carry), "tree")
    for k in range(len(levels) - 2, -1, -1):
        kept = carry if k == 0 else ()
        blocks = _blocks(levels[k], step, kept).join(above.withColumnRenamed("pos", "block"), ["tree", "block"])

        def child(made, c, i, kept=kept):
            def sibling(nodes, level):
                at = F.call_function("shiftright", i, level)
                return F.struct(F.get(nodes, at.bitwiseXOR(F.lit(1))).alias("d"), (at.bitwiseAND(F.lit(1)) == 1).alias("left"))

            own = F.transform(F.slice(made, F.lit(1), F.size(made) - 1), sibling)
            return F.struct(c["pos"].alias("pos"), c["d"].alias("d"), *(c[x].alias(x) for x in kept), own.alias("own"))

        children = _let(_levels(step), lambda made: F.transform(F.col("c"), lambda c, i: child(made, c, i)))
        rows = blocks.select("tree", "path", *more, F.explode(children).alias("x"))
        above = rows.select("tree", "x.pos", "x.d", F.concat("x.own", "path").alias("path"), *more, *(f"x.{x}" for x in kept))
        if k:
            above = above.drop("d")
    return above


@dataclass
class Manifest:
    """What is stored of a dataset's trees: every ``step``-th level (tree, pos, n, digest), the lowest with the carried columns, and the same for the tree above."""

    levels: list[DataFrame]
    roots: list[DataFrame]
    step: int
    carry: tuple[str, ...]

    def root(self) -> DataFrame:
        """(root): one row, none for an empty table."""
        return self.roots[-1].select(F.lower(F.hex("digest")).alias("root"))

    def subroots(self) -> DataFrame:
        """(tree, subroot, root, path): the roots of the groups' trees, with the siblings above them."""
        one = self.roots[-1].select("tree", F.lower(F.hex("digest")).alias("root"), F.expr("cast(array() AS array<struct<d:string,left:boolean>>)").alias("path"))
        return _paths(self.roots, one, self.step, ("group",)).select(F.col("group").alias("tree"), F.col("d").alias("subroot"), "root", "path")

    def proofs(self) -> DataFrame:
        """(tree, pos, leaf, path, subroot, root, carried columns) of every leaf; path as ``fold`` takes it."""
        return _paths(self.levels, self.subroots(), self.step, self.carry).withColumnRenamed("d", "leaf")


def build_manifest(leaves: DataFrame, carry: tuple[str, ...] = (), step: int = STEP, keep: str | None = None) -> Manifest:
    """The manifest of ``leaves`` (group: string or null, order: the id, leaf: hex digest, carried columns).

    Groups are ordered by UTF-8 bytes, null first; leaves in a group by id, null first, those of one id by
    digest. ``keep``: a folder that all executors share, for the stored levels to stay in; by default they go at the end of the process.
    """
    spark = leaves.sparkSession
    scratch = Scratch(spark, "merkle")
    kept = scratch if keep is None else _Folder(spark, keep)
    # null and every value as a string in the wanted order, so that trees meet by equality; the salt settles rows that are equal in all else
    tree = F.coalesce(F.concat(F.lit("v"), F.col("group").cast("string")), F.lit(""))
    rows = leaves.select(tree.alias("tree"), F.col("order").alias("_order"), F.unhex("leaf").alias("digest"), *(F.col(c).alias(f"_c{k}") for k, c in enumerate(carry)), F.monotonically_increasing_id().alias("_salt"))
    rows = scratch.write(rows, "leaves")
    placed = numbered(scratch, rows, "tree", ["_order", "digest", "_salt"], "placed", "n")
    bottom = kept.write(placed.select("tree", "pos", "n", "digest", *(F.col(f"_c{k}").alias(c) for k, c in enumerate(carry))), "level0")
    scratch.drop("leaves")
    scratch.drop("placed")
    levels = _build(kept, bottom, step, "level")
    tops = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest")
    roots = _build(kept, kept.write(numbered(scratch, tops, "tree", ["group"], "tops", "n").select("tree", "pos", "n", "digest", "group"), "root0"), step, "root")
    return Manifest(levels, roots, step, carry)


class _Folder(Scratch):
    """Tables in a folder of the caller's, which stay."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root.rstrip("/")


def merkle_audit(df: DataFrame, tampered: Column | None = None, step: int = STEP) -> DataFrame:
    """Per input row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``tampered``: where it is true, n_chars is one more than at the time of the manifest when folded_root is made. All
    else is of the untampered table. proof_sha256 is the digest of the siblings, from the leaf's up to the root's.

    Null in any column: told apart from every value; null ids stand first in their group, null n_chars stay as they are when
    tampered with. Repeated rows: leaves of their own, side by side; two equal rows take the two places in any order, so their proofs may change
    places from run to run. Several texts of one id: in the order of their digests. Empty and very long texts: like any other, hashed whole in one row. Empty
    table: no rows. Extra columns are not read.
    """
    values = [F.col(c) for c in FIELDS]
    now = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    changed = leaf_digest(*(F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS))
    leaves = df.select(F.col("lang").alias("group"), F.col("doc_id").alias("order"), leaf_digest(*values).alias("leaf"), "doc_id", F.when(now, F.unhex(changed)).alias("changed"))
    proofs = build_manifest(leaves, ("doc_id", "changed"), step).proofs()
    start = F.coalesce(F.lower(F.hex("changed")), F.col("leaf"))
    told = proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("path.d", ""), 256).alias("proof_sha256"), fold(start, F.col("path")).alias("folded_root"))
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    return merkle_audit(load(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 == 0)


#: The fold of the tampered leaf changes n_chars alone; trees and proofs are recursive queries.
ORACLE = """
WITH RECURSIVE rows AS (
  SELECT doc_id, source, lang, n_chars, text, n_chars + CASE WHEN xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ord(x)::UBIGINT),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda d, z: xor(d >> 1, 3988292384 * (d & 1)))), 4294967295::UBIGINT) % 7 = 0 THEN 1 ELSE 0 END AS m_chars
  FROM documents
), told AS (
  SELECT doc_id, coalesce('v' || lang, '') AS tree, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS a,
    coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS b, coalesce(strlen(CAST(m_chars AS VARCHAR)) || ':' || m_chars, '-') AS m, coalesce(strlen(text) || ':' || text, '-') AS t FROM rows
), hashed AS (
  SELECT doc_id, tree, sha256(a || b || t) AS leaf, sha256(a || m || t) AS changed FROM told
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM hashed
), nodes AS (
  SELECT tree, 0 AS level, pos, n, leaf AS d FROM placed
  UNION ALL SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 2, n
), subroots AS (
  SELECT tree, d AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), upper_nodes AS (
  SELECT 0 AS level, pos, n, subroot AS d FROM subroots
  UNION ALL SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY pos)) FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 2, n
), walk AS (
  SELECT tree, pos AS row, 0 AS level, pos, n, changed AS own, '' AS proof FROM placed
  UNION ALL SELECT w.tree, w.row, w.level + 1, w.pos // 2, (w.n + 1) // 2, sha256(CASE WHEN w.pos % 2 = 1 THEN s.d || w.own ELSE w.own || coalesce(s.d, '') END), w.proof || coalesce(s.d, '')
  FROM walk w LEFT JOIN nodes s ON s.tree = w.tree AND s.level = w.level AND s.pos = xor(w.pos, 1) WHERE w.n > 1
), above AS (
  SELECT w.tree, w.row, 0 AS level, s.pos, s.n, w.own, w.proof FROM walk w JOIN subroots s ON s.tree = w.tree WHERE w.n = 1
  UNION ALL SELECT w.tree, w.row, w.level + 1, w.pos // 2, (w.n + 1) // 2, sha256(CASE WHEN w.pos % 2 = 1 THEN s.d || w.own ELSE w.own || coalesce(s.d, '') END), w.proof || coalesce(s.d, '')
  FROM above w LEFT JOIN upper_nodes s ON s.level = w.level AND s.pos = xor(w.pos, 1) WHERE w.n > 1
)
SELECT p.doc_id, p.leaf, s.subroot, r.d AS root, sha256(a.proof) AS proof_sha256, a.own AS folded_root, a.own = r.d AS verified
FROM placed p JOIN subroots s ON s.tree = p.tree JOIN above a ON a.tree = p.tree AND a.row = p.pos AND a.n = 1 JOIN upper_nodes r ON r.n = 1
"""
