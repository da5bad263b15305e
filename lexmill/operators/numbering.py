"""Numbering rows, over a whole table or inside each parent, without a one-task window.

A parent may own a third of all rows. ``split_hot`` finds such parents by a partially
aggregated count; their rows are numbered by a parallel sort, everybody else's by an
ordinary window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.session import by_rows, cut_lineage

# At most this many parents are treated as hot, the largest ones, so their list always fits
# a broadcast. The parent after them owns at most total / MAX_HOT rows.
MAX_HOT = 10_000
HOT_FLOOR = 1_000_000
# Keys are counted in so many groups first; a group with no more rows than the floor has no hot key.
HOT_GROUPS = 1 << 14


def hot_keys(df: DataFrame, keys: Sequence[str], floor: int = HOT_FLOOR) -> DataFrame | None:
    """The largest parents, at most MAX_HOT of them, with more than `floor` rows each, or None."""
    group = F.pmod(F.xxhash64(*keys), F.lit(HOT_GROUPS)).cast("int")
    # The counts read the key columns only and are partially aggregated before their shuffle, which
    # holds one row per group and task; single keys are counted in groups that may have a hot one.
    sizes = df.groupBy(group.alias("_g")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > floor)
    large = [r["_g"] for r in sizes.collect()]
    if not large:
        return None
    counts = df.where(group.isin(large)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > floor)
    rows = counts.orderBy(F.col("_n").desc()).limit(MAX_HOT).collect()
    if not rows:
        return None
    schema = counts.drop("_n").schema
    return df.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in rows], schema)


def split_hot(
    df: DataFrame, keys: Sequence[str], floor: int = HOT_FLOOR, weigh: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(rows of ordinary parents, rows of hot parents, the hot parents)."""
    hot = hot_keys(df if weigh is None else weigh, keys, floor)
    if hot is None:
        return df, None, None
    listed = F.broadcast(hot.select(*[F.col(k).alias(f"_hk_{i}") for i, k in enumerate(keys)]))
    # NULL is a key like any other for a window or a grouping, so it is for this split.
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_hk_{i}"))
    return df.join(listed, same, "left_anti"), df.join(listed, same, "left_semi"), hot


def _sorted_offsets(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Sort in parallel and write the result once; `_nr_part` and `_nr_at` locate each row in it."""
    placed = cut_lineage(
        df.orderBy(*keys, *order).withColumn("_nr_mark", F.monotonically_increasing_id())
    )
    return placed.withColumn("_nr_part", F.shiftright("_nr_mark", 33)).withColumn(
        "_nr_at", F.col("_nr_mark").bitwiseAND(F.lit((1 << 33) - 1))
    ).drop("_nr_mark")


def number_rows(df: DataFrame, order: Sequence[Column | str], name: str, start: int | Column = 1) -> DataFrame:
    """Consecutive numbers over the whole table in the given order, from `start`.

    The sort is a range shuffle. Each partition's offset is the size of those before it; that
    table has one row per partition and is broadcast.
    """
    placed = _sorted_offsets(df, [], order)
    before = Window.orderBy("_nr_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_nr_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_nr_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_nr_before")
    )
    first = start if isinstance(start, Column) else F.lit(start)
    return (
        placed.join(F.broadcast(offsets), "_nr_part")
        .withColumn(name, (F.col("_nr_before") + F.col("_nr_at") + first).cast("bigint"))
        .drop("_nr_part", "_nr_at", "_nr_before")
    )


def _number_hot(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str) -> DataFrame:
    placed = _sorted_offsets(df, keys, order)
    before = Window.partitionBy(*keys).orderBy("_nr_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, plus one per hot parent: fewer than partitions + MAX_HOT.
    offsets = (
        placed.groupBy(*keys, "_nr_part")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_nr_at").alias("_nr_low"))
        .select(*keys, "_nr_part", "_nr_low", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_nr_before"))
    )
    offsets = offsets.withColumnsRenamed({k: f"_hk_{i}" for i, k in enumerate(keys)} | {"_nr_part": "_nr_where"})
    same = F.col("_nr_part") == F.col("_nr_where")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_hk_{i}"))
    return (
        placed.join(F.broadcast(offsets), same)
        .withColumn(name, (F.col("_nr_before") + F.col("_nr_at") - F.col("_nr_low")).cast("bigint"))
        .drop("_nr_part", "_nr_at", "_nr_low", "_nr_before", "_nr_where", *[f"_hk_{i}" for i in range(len(keys))])
    )


def number_in_parent(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str, hot: bool = False) -> DataFrame:
    """Zero-based positions by a window, or for rows of hot parents by a parallel sort."""
    if hot:
        return _number_hot(df, keys, order, name)
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("bigint"))


def position_in_parent(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    name: str = "position",
    floor: int = HOT_FLOOR,
    weigh: DataFrame | None = None,
) -> DataFrame:
    """Zero-based position of each row among its parent's rows; `order` must be unique."""
    cold, hot, _ = split_hot(df, keys, floor, weigh)
    numbered = number_in_parent(cold, keys, order, name)
    return numbered if hot is None else numbered.unionByName(number_in_parent(hot, keys, order, name, hot=True))


def join_to_parent(
    child: DataFrame, parent: DataFrame, keys: Sequence[str], how: str = "inner", floor: int = HOT_FLOOR
) -> DataFrame:
    """Equi join to a side that is unique on `keys`, safe when some keys own most child rows.

    Hot parents are fewer than MAX_HOT and one row each, so their side is broadcast and the
    hot child rows stay where they are; the rest is an ordinary join.
    """
    cold, hot, listed = split_hot(child, keys, floor)
    joined = cold.join(by_rows(parent), list(keys), how)
    if hot is not None:
        few = parent.join(F.broadcast(listed), list(keys), "left_semi")
        joined = joined.unionByName(hot.join(F.broadcast(few), list(keys), how))
    return joined
