"""Where two tables differ: digests in a tree of key ranges, descended only where they differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.session import cut_lineage

# A node of the tree has 2^STEP children.
STEP = 4
# The leaves of a tree of so many bits, a number each, are sent to every task.
BROADCAST_BITS = 20


def _leaf(keys: Sequence[str], levels: int) -> Column:
    """A row's leaf: as many bits of its key's hash as the tree is deep; NULL is a key like any other."""
    marks = [F.col(f"`{k}`").isNull() for k in keys]
    return F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{k}`") for k in keys], *marks), 64 - STEP * levels)


def _digest(columns: Sequence[str]) -> Column:
    """64 bits of a row's values; NULL and the empty text differ."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns], *[F.col(f"`{c}`").isNull() for c in columns])


def digest_tree(rows: DataFrame, keys: Sequence[str], levels: int = 4) -> DataFrame:
    """(level, node, n, x, s): number, XOR and sum of the digests of the rows under each node.

    Level 0 is the whole table. Every row is read once; upper levels are added up from the
    leaves, of which there are 2^(STEP * levels) at most.
    """
    digest = _digest(sorted(rows.columns))
    base = rows.select(_leaf(keys, levels).alias("node"), digest.alias("d"))
    at = base.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("d").alias("x"), F.sum(F.col("d").cast("decimal(20,0)")).cast("decimal(38,0)").alias("s"))
    leaves = cut_lineage(at)
    out = leaves.select(F.lit(levels).alias("level"), "*")
    for level in range(levels - 1, -1, -1):
        up = leaves.withColumn("node", F.shiftrightunsigned("node", STEP * (levels - level))).groupBy("node").agg(
            F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.sum("s").cast("decimal(38,0)").alias("s")
        )
        out = out.unionByName(up.select(F.lit(level).alias("level"), "*"))
    return out


def differing_leaves(one: DataFrame, other: DataFrame, levels: int = 4) -> DataFrame:
    """(node): leaves under which two trees differ, found from the root down; below equal nodes nothing is looked at."""
    left = one.select("level", "node", *[F.col(c).alias(f"{c}1") for c in ("n", "x", "s")])
    right = other.select("level", "node", *[F.col(c).alias(f"{c}2") for c in ("n", "x", "s")])
    same = F.lit(True)
    for c in ("n", "x", "s"):
        same = same & F.col(f"{c}1").eqNullSafe(F.col(f"{c}2"))
    found = None
    for level in range(levels + 1):
        a, b = left.where(F.col("level") == level), right.where(F.col("level") == level)
        if found is not None:
            above = found.withColumnRenamed("node", "_above")
            a, b = (side.join(above, F.shiftrightunsigned("node", STEP) == F.col("_above"), "left_semi") for side in (a, b))
        found = cut_lineage(a.join(b, ["level", "node"], "full_outer").where(~same).select("node"))
    return found


def drift_rows(source: DataFrame, target: DataFrame, keys: Sequence[str], levels: int = 4) -> DataFrame:
    """(keys, drift): rows that are `missing` in the target, `extra` there, or `changed`.

    Both tables are read once for their trees; only rows under differing leaves are then joined.
    `keys` name a row; repeated rows of a key count as changed if their numbers or values differ. Columns
    must be the same on both sides.
    """
    if sorted(source.columns) != sorted(target.columns):
        raise ValueError("both tables must have the same columns")
    leaves = differing_leaves(digest_tree(source, keys, levels), digest_tree(target, keys, levels), levels)
    if STEP * levels <= BROADCAST_BITS:
        leaves = F.broadcast(leaves)

    def side(rows: DataFrame, first: bool) -> DataFrame:
        marked = rows.select(*[F.col(f"`{k}`") for k in keys], _leaf(keys, levels).alias("_node"), _digest(sorted(rows.columns)).alias("_d"))
        return marked.join(leaves.withColumnRenamed("node", "_node"), "_node", "left_semi").drop("_node").withColumn("_first", F.lit(first))

    # Rows of both sides meet in one grouping, where equal ones cancel each other out.
    amount = F.col("_d").cast("decimal(20,0)")
    met = side(source, True).unionByName(side(target, False)).groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        F.count_if("_first").alias("_a"), F.count_if(~F.col("_first")).alias("_b"), F.bit_xor("_d").alias("_x"),
        F.sum(F.when(F.col("_first"), amount).otherwise(-amount)).alias("_s"),
    )
    same = (F.col("_a") == F.col("_b")) & (F.col("_x") == 0) & (F.col("_s") == 0)
    drift = F.when(F.col("_b") == 0, "missing").when(F.col("_a") == 0, "extra").when(~same, "changed")
    return met.select(*[F.col(f"`{k}`") for k in keys], drift.alias("drift")).where("drift IS NOT NULL")
