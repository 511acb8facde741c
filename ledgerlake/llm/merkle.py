"""Merkle manifest of a table: a tree over the rows of each group, and one over the groups' roots.

Levels are built by sibling-shift self-joins: a node at place i of its level joins the nodes at the places that share its run of `arity` (i XOR 1 for
a binary tree, slot offsets within the run otherwise), and the rows at slot zero emit the parents. A tree of a hot group grows like any other, as the
joins are by (tree, place). The joined siblings stay with their node: they are the audit path, level by level, so proofs are read off the same tables
from the top down, each level one join of a node with its parent.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, numbered

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:binary,after:binary>>"


def digest(data: Column) -> Column:
    """SHA-256 of the hex text of concatenated digests, as 32 bytes."""
    return F.unhex(F.sha2(F.lower(F.hex(data)), 256))


def leaf(columns: tuple[str, ...] | list[str], **changed: Column) -> Column:
    """SHA-256 of a row's columns, as 32 bytes: `-` for null, else byte count, colon and value. `changed` stands in for a column of that name."""

    def part(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[part(c) for c in columns]), 256))


@dataclass
class Tree:
    """levels: per level tree, idx, n (nodes of its tree there), hash, before and after (its siblings' hashes); tops: tree, level, hash of each root."""

    leaves: DataFrame
    levels: list[DataFrame] = field(default_factory=list)
    tops: DataFrame | None = None


def grow(nodes: DataFrame, arity: int = ARITY) -> Tree:
    """nodes (tree, idx from 0, n, hash; any further columns stay in the lowest level) -> the trees' levels and roots."""
    out, height = Tree(nodes), nodes.agg(F.max("n")).first()[0] or 0
    tops = nodes.where("n = 1").select("tree", F.lit(0).alias("level"), "hash")
    while height > 1:
        live = nodes.where("n > 1")
        slot, joined, near = F.col("idx") % arity, live, []
        for k in range(1, arity):
            sibling = F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("idx") - slot + (slot + k) % arity
            other = live.select("tree", F.col("idx").alias(f"_at{k}"), F.col("hash").alias(f"_hash{k}"))
            joined = joined.withColumn(f"_at{k}", sibling).join(other, ["tree", f"_at{k}"], "left")
            near.append(F.struct(F.col(f"_at{k}").alias("at"), F.col(f"_hash{k}").alias("hash")))
        have = F.array_sort(F.filter(F.array(*near), lambda x: x["hash"].isNotNull()))

        def side(keep, have=have) -> Column:
            return F.aggregate(F.filter(have, keep), F.lit(b""), lambda acc, x: F.concat(acc, x["hash"]))

        level = materialise(joined.select(*live.columns, side(lambda x: x["at"] < F.col("idx")).alias("before"), side(lambda x: x["at"] > F.col("idx")).alias("after")), "merkle")
        out.levels.append(level)
        parent = digest(F.concat("hash", "after"))
        nodes = level.where(slot == 0).select("tree", F.floor(F.col("idx") / arity).alias("idx"), F.floor((F.col("n") + arity - 1) / arity).alias("n"), parent.alias("hash"))
        tops = tops.unionByName(nodes.where("n = 1").select("tree", F.lit(len(out.levels)).alias("level"), "hash"))
        height = -(-height // arity)
    out.tops = materialise(tops, "merkle-tops")
    return out


def paths(tree: Tree, above: DataFrame, arity: int = ARITY) -> DataFrame:
    """The leaves with `path`, the siblings before and after at each level up to the root of all, and `top`, their own tree's root.

    above: tree and path of each tree's root in the tree over it."""
    tops = tree.tops.join(above, "tree").select("tree", "level", "path", F.col("hash").alias("top"))
    up = tops.where(F.col("level") == len(tree.levels)).select("tree", F.lit(0).cast("long").alias("idx"), "path", "top")
    for k in range(len(tree.levels) - 1, -1, -1):
        nodes = tree.levels[k] if k == 0 else tree.levels[k].select("tree", "idx", "before", "after")
        parents = up.withColumnRenamed("idx", "_run")
        joined = nodes.withColumn("_run", F.floor(F.col("idx") / arity)).join(parents, ["tree", "_run"])
        joined = joined.withColumn("path", F.concat(F.array(F.struct("before", "after")), F.col("path"))).drop("_run", "before", "after")
        alone = tops.where(F.col("level") == k)
        if k:
            up = materialise(joined.select("tree", "idx", "path", "top").unionByName(alone.select("tree", F.lit(0).cast("long").alias("idx"), "path", "top")), "merkle-paths")
        else:
            up = joined.unionByName(tree.leaves.where("n = 1").join(alone.drop("level"), "tree"))
    return up if tree.levels else tree.leaves.join(tops.drop("level"), "tree")


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf's hash and its path lead to."""
    return F.aggregate(path, start, lambda acc, step: digest(F.concat(step["before"], acc, step["after"])))


def proof(path: Column) -> Column:
    """SHA-256 (hex) of all siblings on the path, left to right, level by level."""
    return F.sha2(F.lower(F.hex(F.aggregate(path, F.lit(b""), lambda acc, step: F.concat(acc, step["before"], step["after"])))), 256)


def manifest(docs: DataFrame, *, fields: tuple[str, ...] = FIELDS, arity: int = ARITY, id_col: str = "doc_id", group_col: str = "source", check: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, leaf, presented, top, root (32 bytes each) and path of every row of docs.

    A row's leaf is the hash of its fields; leaves of a group ascend by id (null first; ties by leaf, so repeated rows are all in the tree), and the
    groups' roots by group (null first, bytewise). `presented` is the leaf with the columns in `check` as they are found now, where the row's id
    has one; fold(presented, path) = root tells whether the row is still what the manifest was made of. No rows give none."""
    grouped = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), grouped.alias("tree"), leaf(fields).alias("hash"), (leaf(fields, **check) if check else F.lit(None).cast("binary")).alias("presented"))
    leaves = numbered(rows, ["tree"], ["doc_id", "hash"], "merkle-leaves").withColumnsRenamed({"at": "idx", "size": "n"})
    below = grow(leaves, arity)
    tops = numbered(below.tops.select(F.lit("").alias("tree"), F.col("tree").alias("below"), "hash"), [], ["below"], "merkle-groups").withColumnsRenamed({"at": "idx", "size": "n"})
    over = grow(tops, arity)
    root = over.tops.first()
    above = paths(over, over.tops.select("tree", F.lit([]).cast(PATH).alias("path")), arity).select(F.col("below").alias("tree"), "path")
    out = paths(below, above, arity)
    return out.select("doc_id", F.col("hash").alias("leaf"), F.coalesce("presented", "hash").alias("presented"), "top", F.lit(bytes(root["hash"]) if root else None).cast("binary").alias("root"), "path")


def audit(docs: DataFrame, check: dict[str, Column], *, fields: tuple[str, ...] = FIELDS, arity: int = ARITY, id_col: str = "doc_id", group_col: str = "source") -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root (hex) and verified: the manifest of docs held against the rows as `check` finds them."""
    found = manifest(docs, fields=fields, arity=arity, id_col=id_col, group_col=group_col, check=check)
    hexed = lambda c: F.lower(F.hex(c))
    out = found.select("doc_id", hexed("leaf").alias("leaf"), hexed("top").alias("subroot"), hexed("root").alias("root"), proof(F.col("path")).alias("proof_sha256"), hexed(fold(F.col("presented"), F.col("path"))).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
