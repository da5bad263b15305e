"""Near-duplicate vectors by a forest of random-projection trees with spill."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.components import connected_components
from lexmill.session import cut_lineage

THRESHOLD = 0.93
TREES = 6
# Vectors within this distance of a split's threshold go to both sides.
SPILL = 0.02
# The splits' thresholds are medians over a sample of at most this many vectors.
SAMPLE = 20_000
# Vectors of one label that a leaf should hold, and that a task compares at a time with as many
# others; a larger leaf is compared chunk by chunk.
LEAF = 400
CHUNK = 1_024
# A node is a leaf if a split would leave a side with more than this share of it.
LEAST_GAIN = 0.9
MIN_NODE_SAMPLE = 16


class Split(NamedTuple):
    direction: np.ndarray
    threshold: float
    below: Split | int
    above: Split | int


def grow_forest(sample: np.ndarray, total: int, target: float, trees: int = TREES, spill: float = SPILL, seed: int = 7) -> list[Split | int]:
    """Trees over unit vectors; leaves are numbered through all trees, tree by tree.

    A node is split at the median of a random direction until it holds about `target` of all
    `total` vectors, or until its vectors lie too close to each other for a split to part them.
    """
    rng = np.random.default_rng(seed)
    share = total / max(len(sample), 1)
    number = 0

    def grow(points: np.ndarray) -> Split | int:
        nonlocal number
        if len(points) * share > target and len(points) >= MIN_NODE_SAMPLE:
            for _ in range(3):
                direction = rng.standard_normal(points.shape[1])
                direction /= np.linalg.norm(direction)
                line = points @ direction
                threshold = float(np.median(line))
                below, above = line <= threshold + spill, line > threshold - spill
                if max(below.sum(), above.sum()) <= LEAST_GAIN * len(points):
                    return Split(direction, threshold, grow(points[below]), grow(points[above]))
        number += 1
        return number - 1

    return [grow(sample) for _ in range(trees)]


def leaves_of(forest: list[Split | int], points: np.ndarray, spill: float = SPILL) -> list[list[int]]:
    """For each point its leaves in all trees, in ascending order."""
    found: list[list[int]] = [[] for _ in range(len(points))]

    def descend(node: Split | int, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if isinstance(node, int):
            for r in rows.tolist():
                found[r].append(node)
            return
        line = points[rows] @ node.direction
        descend(node.below, rows[line <= node.threshold + spill])
        descend(node.above, rows[line > node.threshold - spill])

    for tree in forest:
        descend(tree, np.arange(len(points)))
    return [sorted(x) for x in found]


def unit(points: np.ndarray) -> np.ndarray:
    """Rows divided by their lengths; by their largest component first, so that no square overflows or vanishes."""
    points = points / np.abs(points).max(axis=1, keepdims=True, initial=0)
    return points / np.linalg.norm(points, axis=1, keepdims=True)


def usable(vector: Column, label: Column) -> Column:
    """Whether a vector can link: labelled, without missing or non-finite components, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(label.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return rows.reshape(len(column), -1) if len(column) else rows.reshape(0, 0)


def _with_leaves(classes: DataFrame, forests: dict[int, list]) -> DataFrame:
    """`classes` with the column `leaves`."""
    shared = classes.sparkSession.sparkContext.broadcast(forests)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(batch.schema.names.index("vector"))
            width = np.array([len(v) for v in vectors])
            leaves: list[list[int]] = [[0]] * batch.num_rows
            for size in np.unique(width).tolist():
                rows = np.flatnonzero(width == size)
                if size in shared.value:
                    points = unit(_matrix(vectors.take(pa.array(rows))))
                    for r, found in zip(rows.tolist(), leaves_of(shared.value[size], points), strict=True):
                        leaves[r] = found
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.list_(pa.int32()))], names=[*batch.schema.names, "leaves"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(place, f"{fields}, leaves array<int>")


def _sample(classes: DataFrame, total: int) -> dict[int, np.ndarray]:
    """Unit vectors of at most about SAMPLE classes, by dimension; taken by a hash, the same in every run."""
    picked = classes.where(F.pmod(F.xxhash64("class"), F.lit(1_000_003)) < F.lit(int(1_000_003 * min(1.0, SAMPLE / total)) + 1))
    table = picked.select("vector").limit(SAMPLE + SAMPLE // 4).toArrow().column(0)
    by_size: dict[int, list] = {}
    for v in table.to_pylist():
        by_size.setdefault(len(v), []).append(v)
    return {size: unit(np.array(rows, dtype=np.float64)) for size, rows in by_size.items()}


def _earlier_common(left: list[list[int]], right: list[list[int]], leaf: int) -> np.ndarray:
    """Which pairs share a leaf before `leaf`, and so are counted there."""
    names = sorted({x for row in left for x in row if x < leaf} & {x for row in right for x in row if x < leaf})
    at = {x: i for i, x in enumerate(names)}

    def marks(rows: list[list[int]]) -> np.ndarray:
        out = np.zeros((len(rows), max(len(names), 1)), dtype=np.float32)
        for r, row in enumerate(rows):
            for x in row:
                if x in at:
                    out[r, at[x]] = 1
        return out

    return marks(left) @ marks(right).T > 0


def _connect(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric boolean matrix the smallest row it can reach."""
    low = np.arange(len(linked))
    while True:
        seen = np.where(linked, low[None, :], len(linked)).min(axis=1)
        new = np.minimum(low, seen)
        new = np.minimum(new, new[new])
        if (new == low).all():
            return low
        low = new


def compare(vectors: np.ndarray, weights: np.ndarray, chunk: np.ndarray, leaves: list[list[int]], leaf: int, threshold: float):
    """(counts, root) of one group: links first found in this leaf, weighted, and connected rows.

    If the rows are of two chunks, only pairs across them are compared.
    """
    points = unit(vectors)
    linked = points @ points.T >= threshold
    np.fill_diagonal(linked, False)
    if chunk.any() and not chunk.all():
        linked &= chunk[:, None] != chunk[None, :]
    counts = np.zeros(len(points), dtype=np.int64)
    if linked.any():
        rows = np.flatnonzero(linked.any(axis=1))
        some = [leaves[r] for r in rows]
        fresh = linked[np.ix_(rows, rows)] & ~_earlier_common(some, some, leaf)
        counts[rows] = fresh @ weights[rows]
    return counts, _connect(linked)


def _compared(groups: DataFrame, threshold: float) -> DataFrame:
    """(class, links, other): partial link counts of classes, and a class each is connected with."""
    dealt = groups.select(
        F.xxhash64("leaf", "label", "size", "one", "two").alias("group"), "leaf", "class", "vector", "members", (F.col("chunk") == F.col("two")).alias("second"), "leaves"
    ).repartition("group").sortWithinPartitions("group", "class")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done() -> pa.RecordBatch | None:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            if rows.num_rows < 2:
                return None
            names = rows.column(2).to_numpy()
            counts, root = compare(
                _matrix(rows.column(3)), rows.column(4).to_numpy(), rows.column(5).to_numpy(zero_copy_only=False).astype(bool),
                rows.column(6).to_pylist(), rows.column(1)[0].as_py(), threshold,
            )
            use = np.flatnonzero((counts > 0) | (root != np.arange(len(root))))
            if not len(use):
                return None
            return pa.RecordBatch.from_arrays([pa.array(names[use]), pa.array(counts[use]), pa.array(names[root[use]])], names=["class", "links", "other"])

        current = None
        for batch in batches:
            group = batch.column(0).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1, [len(group)]]) if len(group) else [0]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if current is not None and group[a] != current and held:
                    out = done()
                    if out is not None:
                        yield out
                    held.clear()
                current = group[a]
                held.append(batch.slice(int(a), int(b - a)))
        if held:
            out = done()
            if out is not None:
                yield out

    return dealt.mapInArrow(link, "class bigint, links bigint, other bigint")


def near_duplicate_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, chunk: int = CHUNK
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): vectors of one label whose cosine reaches the threshold.

    Equal vectors are one class from the start, with a count. Classes that share a leaf of some
    tree, a label and a dimension are compared in double precision; a pair is counted in the
    first leaf it shares. Leaves too large for one comparison are compared chunk by chunk, all
    pairs of chunks, each its own task; no pair of vectors is ever a row. Thresholds of splits
    come from a bounded sample, all vectors are placed. Unlabelled, NULL and zero vectors and
    those with NULL or non-finite components link with nothing. Repeated ids are rows of their
    own with the smallest id of their component; a NULL id takes part and stays NULL.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label"))
    rows = rows.withColumn("_ok", usable(F.col("vector"), F.col("label")))
    # Spark's grouping treats 0.0 and -0.0 alike, as the cosine does.
    grouped = rows.where("_ok").groupBy("label", "vector").agg(F.count(F.lit(1)).alias("members"), F.min("vec_id").alias("first"))
    classes = cut_lineage(grouped.withColumn("class", F.monotonically_increasing_id()))
    sizes = classes.groupBy("label").agg(F.count(F.lit(1)).cast("double").alias("n"))
    total, squares = sizes.agg(F.coalesce(F.sum("n"), F.lit(0.0)), F.coalesce(F.sum(F.col("n") * F.col("n")), F.lit(1.0))).first()
    if not total:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    # Labels cut a leaf further: of `total`, a vector shares its label with squares / total.
    target = LEAF * total * total / squares
    forests = {size: grow_forest(sample, int(total), target) for size, sample in _sample(classes, int(total)).items()}
    placed = cut_lineage(_with_leaves(classes, forests))

    seats = placed.select("label", F.size("vector").alias("size"), "class", "vector", "members", "leaves", F.explode("leaves").alias("leaf"))
    crowded = (
        seats.groupBy("leaf", "label", "size").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk)
        .select("leaf", "label", "size", F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    )
    seated = seats.join(crowded, ["leaf", "label", "size"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    seated = seated.withColumn("chunk", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int"))
    seated = seated.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    groups = seated.withColumn("one", F.least("chunk", "with")).withColumn("two", F.greatest("chunk", "with"))
    # Within a chunk all pairs are compared: its rows all lie in the second half, and in no first.
    found = cut_lineage(_compared(groups, threshold))

    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("class").alias("a"), F.col("other").alias("b")))
    named = classes.select("class", "label", "vector", "members", "first").join(links, "class", "left")
    named = named.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    summed = named.join(lowest, "root").select(
        "label", "vector", (F.col("members") - 1 + F.coalesce("links", F.lit(0))).cast("bigint").alias("n_links"), "component_id"
    )
    linked = rows.where("_ok").join(summed, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("_ok")).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
