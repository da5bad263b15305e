"""Look-ups in keyed tables where one key may hold a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys with more than one of so many rows are broadcast; there are at most so many of them.
HOT_KEYS = 1_000


def free_names(frame: DataFrame, *wanted: str) -> list[str]:
    """Column names that `frame` does not have, made from those wanted; case does not tell names apart."""
    taken = {c.lower() for c in frame.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def look_up(rows: DataFrame, table: DataFrame, keys: Sequence[str], weight: str, total: int) -> DataFrame:
    """Left join of `rows` with `table`, which has one row per key; NULL keys match NULL keys.

    `weight` is a column of `table`: how many of the `total` rows have the key. Keys above
    total / HOT_KEYS, at most HOT_KEYS of them, are broadcast. The rows they serve are dealt out
    by their other values in the shuffled join of all other keys, so no task gets more than its
    share. `weight` is not in the result.
    """
    values = [c for c in table.columns if c not in keys and c != weight]
    names = free_names(rows, *[f"_{i}" for i in range(len(keys) + len(values))], "_hot", "_salt")
    key_names, value_names, hot_name, salt_name = names[: len(keys)], names[len(keys) : -2], names[-2], names[-1]

    def side(part: DataFrame, suffix: str, extra: Column, extra_name: str) -> DataFrame:
        return part.select(
            *[F.col(k).alias(n + suffix) for k, n in zip(keys, key_names, strict=True)],
            *[F.col(v).alias(n + suffix) for v, n in zip(values, value_names, strict=True)],
            extra.alias(extra_name),
        )

    def same(suffix: str) -> Column:
        match = F.lit(True)
        for k, n in zip(keys, key_names, strict=True):
            match = match & F.col(f"`{k}`").eqNullSafe(F.col(n + suffix))
        return match

    floor = total // HOT_KEYS
    hot = side(table.where(F.col(weight) > floor), "h", F.lit(True), hot_name)
    rest = side(table.where(F.col(weight) <= floor), "r", F.lit(0).cast("bigint"), salt_name + "r")
    met = rows.join(F.broadcast(hot), same("h"), "left")
    spread = F.when(F.col(hot_name), F.monotonically_increasing_id() + 1).otherwise(F.lit(0).cast("bigint"))
    both = met.withColumn(salt_name, spread)
    joined = both.join(rest, same("r") & (F.col(salt_name) == F.col(salt_name + "r")), "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in rows.columns],
        *[F.when(F.col(hot_name), F.col(n + "h")).otherwise(F.col(n + "r")).alias(v) for v, n in zip(values, value_names, strict=True)],
    )
