"""Connected components of a distributed link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.session import cut_lineage


def _fingerprint(pairs: DataFrame) -> tuple:
    mixed = F.xxhash64("high", "low")
    return tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(mixed), F.bit_xor(F.xxhash64(mixed))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b): root is the smallest node it can reach.

    Rounds of large-star and small-star: each node hands its larger neighbours, then its smaller
    ones, to the smallest node it knows, until nothing changes; the number of rounds grows with
    the logarithm of the longest path. Minima are aggregated before they are shuffled, so a node
    with very many links costs no task more than its share; each round is written to the shared
    folder. Links of a node to itself and repeated links change nothing; NULL nodes are ignored.
    The smallest node of a component is not in the result, nor are nodes without links.
    """
    both = links.where("a <> b")
    pairs = cut_lineage(both.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct())
    seen = _fingerprint(pairs)
    while seen[0]:
        sides = pairs.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
            pairs.select(F.col("low").alias("node"), F.col("high").alias("other"))
        )
        least = sides.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("least"))
        large = sides.where("other > node").join(least, "node").select(F.col("other").alias("high"), F.col("least").alias("low"))
        smallest = large.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least"))
        handed = large.join(smallest, large["high"] == smallest["node"])
        small = handed.where("low <> least").select(F.col("low").alias("high"), F.col("least").alias("low"))
        pairs = cut_lineage(small.unionByName(smallest.select(F.col("node").alias("high"), F.col("least").alias("low"))).distinct())
        now = _fingerprint(pairs)
        if now == seen:
            break
        seen = now
    return pairs.select(F.col("high").alias("node"), F.col("low").alias("root"))
