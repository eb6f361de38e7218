"""Merkle manifest of a dataset: one tree for each source, one over their roots.

A row's leaf is the SHA-256 of its columns.  Leaves of a source ascend by id, and
runs of FAN nodes become their parent until one is left.  Only every LEVELS-th
level is stored: a stored node stands for an aligned subtree of FAN ** LEVELS
stored descendants.  A proof goes from the top down; at each stored level the
missing nodes of every subtree are made again from its stored descendants, their
siblings are handed out and the nodes are forgotten.  A subtree has a bounded
size, so a source of any size is spread over the tasks.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from paneldeck.llm.order import in_order, numbered
from paneldeck.session import write_stage

FAN = 3
LEVELS = 4
RUN = FAN ** LEVELS
HEX = 64
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def framed(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_hash(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[framed(c) for c in columns]), 256)


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left, at most LEVELS."""
    levels = 0
    while n > 1 and levels < LEVELS:
        n, levels = -(-n // FAN), levels + 1
    return levels


def regrown(stored: str, n: int) -> list[list[str]]:
    """All levels of the subtree above stored descendants (hex digests in order,
    joined); ``n`` is the number of nodes of the whole tree at that level."""
    levels = [[stored[i:i + HEX] for i in range(0, len(stored), HEX)]]
    for _ in range(height(n)):
        low = levels[-1]
        levels.append([hashlib.sha256("".join(low[i:i + FAN]).encode()).hexdigest() for i in range(0, len(low), FAN)])
    return levels


def local_paths(levels: list[list[str]]) -> list[list[str]]:
    """For each stored descendant the siblings on its left and on its right, level
    by level up to the top of the subtree."""
    out = []
    for at in range(len(levels[0])):
        path = []
        for nodes in levels[:-1]:
            start = at - at % FAN
            path += ["".join(nodes[start:at]), "".join(nodes[at + 1:start + FAN])]
            at //= FAN
        out.append(path)
    return out


@F.pandas_udf(StringType())
def subtree_top(stored: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([regrown(s, int(m))[-1][0] for s, m in zip(stored, n)])


@F.pandas_udf(ArrayType(ArrayType(StringType())))
def subtree_paths(stored: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([local_paths(regrown(s, int(m))) for s, m in zip(stored, n)])


def runs(nodes: DataFrame, carry: list[str]) -> DataFrame:
    """One row for each aligned subtree: tree, up (its number), n, items (at most
    RUN, in order), stored (their digests)."""
    return (nodes.where("n > 1").groupBy("tree", F.floor(F.col("j") / RUN).alias("up"))
            .agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("j", "hash", *carry))).alias("items"))
            .withColumn("stored", F.array_join(F.col("items.hash"), "")))


@dataclass
class Forest:
    """Trees whose every LEVELS-th level is stored: tables of tree, j, n, hash, the
    leaves (with the carried columns) first."""

    levels: list[DataFrame]
    carry: list[str]

    @classmethod
    def grow(cls, leaves: DataFrame, carry: list[str], name: str) -> Forest:
        """``leaves``: tree, j, n, hash and carried columns.  One number, the size
        of the largest tree, reaches the driver at each stored level."""
        levels = [write_stage(leaves, f"{name}-leaves")]
        while (levels[-1].agg(F.max("n")).first()[0] or 1) > 1:
            up = runs(levels[-1].select("tree", "j", "n", "hash"), []).select(
                "tree", F.col("up").alias("j"), F.ceil(F.col("n") / RUN).alias("n"),
                subtree_top("stored", "n").alias("hash"))
            levels.append(write_stage(up, f"{name}-level"))
        return cls(levels, carry)

    def roots(self) -> DataFrame:
        """tree, hash of the root of each tree."""
        tops = [level.where("n = 1").select("tree", "hash") for level in self.levels]
        out = tops[0]
        for t in tops[1:]:
            out = out.unionByName(t)
        return out

    def proofs(self, above: DataFrame) -> DataFrame:
        """tree, hash, carried columns and path of every leaf.  ``above``: tree and
        path, the way from the tree's root on, and columns to hand down."""
        hand = [c for c in above.columns if c not in ("tree", "path")]
        known = None
        for depth in range(len(self.levels) - 1, -1, -1):
            level, carry = self.levels[depth], self.carry if depth == 0 else []
            done = level.where("n = 1").join(above, "tree").select("tree", "j", "hash", *carry, *hand, "path")
            if known is not None:
                parents = known.select("tree", F.col("j").alias("up"), *hand, "path")
                item = F.explode(F.arrays_zip("items", "local")).alias("item")
                below = (runs(level, carry).withColumn("local", subtree_paths("stored", "n"))
                         .join(parents, ["tree", "up"])
                         .select("tree", *hand, "path", item)
                         .select("tree", "item.items.*", *hand, F.concat("item.local", "path").alias("path")))
                done = done.unionByName(below)
            known = done
        return known.drop("j")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path (left and right siblings by turns) give."""
    step = lambda at, i: F.sha2(F.concat(F.element_at(path, 2 * i + 1), at, F.element_at(path, 2 * i + 2)), 256)
    return F.when(F.size(path) == 0, leaf).otherwise(
        F.aggregate(F.sequence(F.lit(0), (F.size(path) / 2).cast("int") - 1), leaf, step))


def manifest_proofs(docs: DataFrame, id_col: str = "doc_id", tree_col: str = "source",
                    columns: tuple[str, ...] = COLUMNS, claimed: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: id, leaf, claimed_leaf, subroot, root, path.

    ``path`` alternates the joined digests of the siblings on the left and on the
    right, from the leaf's level to the root over all sources.  ``claimed``
    replaces columns by what someone says they hold; ``claimed_leaf`` is the leaf
    of such a row, to be folded with the path of the stored one.

    Null columns count as ``-``; null sources make a tree of their own, before all
    others; null ids come first in their tree.  Rows of the same id are ordered by
    their leaves; repeated rows are leaves of their own.  Texts of any length are
    hashed whole, in one pass that keeps digests only.  An empty table gives an
    empty result.  Other columns are not read.
    """
    claimed = claimed or {}
    rows = write_stage(docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.concat(F.lit("1"), F.col(tree_col).cast("string")), F.lit("0")).alias("tree"),
        leaf_hash([F.col(c) for c in columns]).alias("hash"),
        leaf_hash([claimed.get(c, F.col(c)) for c in columns]).alias("claimed_leaf"),
        F.monotonically_increasing_id().alias("row")), "manifest-rows")
    keys = [F.asc("tree"), F.asc_nulls_first("id"), F.asc("hash"), F.asc("row")]
    leaves = numbered(in_order(rows, keys, "manifest-order"), "tree")
    trees = Forest.grow(leaves.select("tree", "j", "n", "hash", "id", "claimed_leaf"), ["id", "claimed_leaf"], "manifest")
    tops = in_order(trees.roots().select(F.col("tree").alias("source_tree"), "hash", F.lit("").alias("tree")),
                    [F.asc("source_tree")], "manifest-tops")
    top = Forest.grow(numbered(tops, "tree").select("tree", "j", "n", "hash", "source_tree"), ["source_tree"], "manifest-top")
    root = top.roots().first()
    start = top.roots().select("tree", F.array().cast("array<string>").alias("path"))
    above = write_stage(top.proofs(start).select(F.col("source_tree").alias("tree"), F.col("hash").alias("subroot"), "path"),
                        "manifest-above")
    return trees.proofs(above).select(
        F.col("id").alias(id_col), F.col("hash").alias("leaf"), "claimed_leaf", "subroot",
        F.lit(root["hash"] if root else None).cast("string").alias("root"), "path")
