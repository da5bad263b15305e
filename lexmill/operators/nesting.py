"""Collecting children under their parent: as arrays in bounded parts, or as one text put together in two levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.operators.numbering import HOT_FLOOR, number_in_parent, position_in_parent, split_hot

# No array ever holds more children than this. Parents with more continue in further parts.
PART_SIZE = 1_000
# Fragments that are joined at a time.
FRAGMENTS = 1_000


def nest_children(
    children: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    item: Column,
    name: str,
    part_size: int = PART_SIZE,
    floor: int = HOT_FLOOR,
    weigh: DataFrame | None = None,
) -> DataFrame:
    """(keys, part_no, name): children as ordered arrays of at most `part_size` items.

    A parent with up to `part_size` children has exactly one part, number 0. A larger one
    continues in parts 1, 2, ...; reading its parts in order gives all children in order.
    The window and the grouping share one shuffle on the keys. `weigh`, when given, has the
    same parents with about the same number of rows and is cheaper to count.
    """
    placed = position_in_parent(children, keys, order, "_pos", floor, weigh)
    return (
        placed.select(*keys, F.expr(f"_pos div {part_size}").alias("part_no"), "_pos", item.alias("_item"))
        .groupBy(*keys, "part_no")
        .agg(F.array_sort(F.collect_list(F.struct("_pos", "_item"))).alias("_items"))
        .select(*keys, "part_no", F.col("_items._item").alias(name))
    )


def joined_children(
    children: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    fragments: dict[str, Column],
    fragments_at_once: int = FRAGMENTS,
    floor: int = HOT_FLOOR,
    weigh: DataFrame | None = None,
    whole: str | None = None,
    ranged: bool = False,
) -> DataFrame:
    """(keys, one text per name): every parent's fragments in order, joined by commas, however many there are.

    A child has one fragment under one of the names and NULL under the others; `order` must be
    unique among a parent's children. Fragments are already text, so what is collected is no larger than the result. They are joined
    `fragments_at_once` at a time and the pieces once more. An ordinary parent's rows meet in one
    shuffle on the keys; those of a parent above `floor` are numbered by a parallel sort, and its
    pieces made in as many tasks as there are pieces, so that only the pieces meet.

    `whole` names a column that few rows of a parent have; its values that are not NULL come as an array.
    With `ranged` ordinary parents are dealt out in ranges of their keys, so that a sort by the keys moves no row again.
    """
    cold, hot, _ = split_hot(children, keys, floor, weigh)
    beside = [whole] if whole else []
    if ranged:
        cold = cold.repartitionByRange(*keys)

    def joined(placed: DataFrame) -> DataFrame:
        rows = placed.select(*keys, "_pos", F.expr(f"_pos div {fragments_at_once}").alias("_piece"), *[c.alias(n) for n, c in fragments.items()], *beside)
        pieces = rows.groupBy(*keys, "_piece").agg(*[_in_order("_pos", name) for name in fragments], *[F.collect_list(c).alias(c) for c in beside])
        return pieces.groupBy(*keys).agg(*[_in_order("_piece", name) for name in fragments], *[F.flatten(F.collect_list(c)).alias(c) for c in beside])

    out = joined(number_in_parent(cold, keys, order, "_pos"))
    return out if hot is None else out.unionByName(joined(number_in_parent(hot, keys, order, "_pos", hot=True)))


def _in_order(place: str, name: str) -> Column:
    """The texts of a group that are not NULL, in order of `place`, joined by commas; NULL if there are none."""
    found = F.array_sort(F.collect_list(F.when(F.col(name).isNotNull(), F.struct(F.col(place).alias("p"), F.col(name).alias("t")))))
    return F.when(F.count(name) > 0, F.array_join(F.transform(found, lambda x: x["t"]), ",")).alias(name)
