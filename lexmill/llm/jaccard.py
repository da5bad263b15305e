"""Exact Jaccard join of shingle sets by signature trees."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from lexmill.llm.components import connected_components
from lexmill.llm.skew import free_names, look_up
from lexmill.llm.textkit import batches_of, distinct_sorted, mix64, releasing, slices, words_of
from lexmill.session import cut_lineage

WIDTH = 4
# Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 85
# Counters of the sketch that orders shingles, and the blocks in which they travel.
SKETCH = 1 << 18
SKETCH_BLOCKS = 16
# Sets of one cell that a task looks at together; a larger cell is cut into chunks of as many.
# A set counts once more for every SET_WEIGHT shingles in it.
CHUNK = 4_096
SET_WEIGHT = 512
# Bits of a set's bitmap for each of its shingles, at least: where only bitmaps travel, and
# where whole sets are at hand.
WIDEN = 3
EXACT_WIDEN = 16
# A first, small bitmap covers one in 2^THIN shingles.
THIN = 3
# Bits of a filter for each wanted document, and at most.
FILTER_BITS = 16
MAX_FILTER_BITS = 1 << 27
# Rows of texts or of whole sets that travel to and from Python at a time.
TEXT_ROWS = 1_000
SET_ROWS = 250
# Sets in a leaf of a signature tree, and children of a node.
LEAF = 8
FAN = 8


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64), pa.int64())


def shingle_sets(part: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, shingle, size, key): distinct shingles by document, set sizes, and each set's hash."""
    words = words_of(part)
    doc, hashes = distinct_sorted(*words.shingles(width))
    size = np.bincount(doc, minlength=part.num_rows).astype(np.int64)
    key = np.zeros(part.num_rows, dtype=np.uint64)
    np.add.at(key, doc, mix64(hashes))
    return doc, hashes, size, mix64(key + size.astype(np.uint64))


def bitmap(hashes: np.ndarray, widen: int = WIDEN) -> bytes:
    """A set's bitmap: one of 2^k bits, at least `widen` for each member, is set by a member's last k bits."""
    width = 1 << max(6, (widen * len(hashes) - 1).bit_length())
    flags = np.zeros(width, dtype=np.uint8)
    flags[(hashes & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def thin_bitmap(hashes: np.ndarray) -> bytes:
    """The bitmap of those members whose first THIN bits are 0: it bounds overlaps too, if less closely."""
    return bitmap(hashes[hashes >> np.uint64(64 - THIN) == 0])


def _profiles(docs: DataFrame, width: int) -> DataFrame:
    """A row (doc_id, n, key, bits, thin) for each document, and the task's share of the sketch in further rows."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, dtype=np.int64)
        names = ["doc_id", "n", "key", "bits", "thin", "block", "counts"]
        id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            for part in slices(batch):
                _, hashes, size, key = shingle_sets(part, width)
                ends = np.concatenate([[0], np.cumsum(size)]).tolist()
                sets = [hashes[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
                sketch += np.bincount((hashes & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
                empty = size == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(size),
                        pa.array(key.view(np.int64), pa.int64(), mask=empty),
                        pa.array([bitmap(s) for s in sets], pa.binary()),
                        pa.array([thin_bitmap(s) for s in sets], pa.binary()),
                        pa.nulls(part.num_rows, pa.int32()),
                        pa.nulls(part.num_rows, pa.binary()),
                    ],
                    names=names,
                )
        if sketch.any():
            blocks = np.split(sketch, SKETCH_BLOCKS)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(SKETCH_BLOCKS, id_type),
                    pa.array([0] * SKETCH_BLOCKS, pa.int64()),
                    pa.nulls(SKETCH_BLOCKS, pa.int64()),
                    pa.nulls(SKETCH_BLOCKS, pa.binary()),
                    pa.nulls(SKETCH_BLOCKS, pa.binary()),
                    pa.array(range(SKETCH_BLOCKS), pa.int32()),
                    pa.array([b.astype(np.uint32).tobytes() for b in blocks], pa.binary()),
                ],
                names=names,
            )

    return docs.mapInArrow(releasing(profile), f"doc_id {kind}, n bigint, key bigint, bits binary, thin binary, block int, counts binary")


def _sketch(profiles: DataFrame) -> np.ndarray:
    """Counts of shingles by their hash's last bits, added up over all tasks: a fixed number of bytes."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(counts, dtype=np.uint32).astype(np.uint64)
                total[block] = total[block] + part if block in total else part
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["block", "sums"]
            )

    rows = profiles.where("block IS NOT NULL").select("block", "counts").repartition(SKETCH_BLOCKS, "block")
    sketch = np.zeros(SKETCH, dtype=np.uint64)
    step = SKETCH // SKETCH_BLOCKS
    for row in rows.mapInArrow(releasing(add), "block int, sums binary").collect():
        sketch[row["block"] * step : (row["block"] + 1) * step] += np.frombuffer(row["sums"], dtype=np.uint64)
    return sketch


def _prefixes(docs: DataFrame, sketch: np.ndarray, width: int, percent: int) -> DataFrame:
    """(token, n, key): the rarest shingles of each set, so many that linked sets share one of them.

    Of a set of n, any ceil(n * percent / 100) - 1 shingles may be missing from a linked set; the
    others, in one order for all sets, must contain a shared one. A task lists equal sets once.
    Sets so small that no different set can link are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed: set[int] = set()
        counts = shared.value
        for batch in batches:
            for part in slices(batch):
                doc, hashes, size, key = shingle_sets(part, width)
                fresh = np.zeros(part.num_rows, dtype=bool)
                for i, k in enumerate(key.tolist()):
                    if size[i] * (100 - percent) >= percent and k not in listed:
                        listed.add(k)
                        fresh[i] = True
                use = fresh[doc]
                doc, hashes = doc[use], hashes[use]
                order = np.lexsort((hashes, counts[(hashes & np.uint64(SKETCH - 1)).astype(np.int64)], doc))
                doc, hashes = doc[order], hashes[order]
                keep = size - -(-size * percent // 100) + 1
                starts = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=part.num_rows))])
                first = np.arange(len(doc)) - starts[doc] < keep[doc]
                doc, hashes = doc[first], hashes[first]
                if len(doc):
                    yield pa.RecordBatch.from_arrays(
                        [_signed(hashes), pa.array(size[doc]), _signed(key[doc])], names=["token", "n", "key"]
                    )

    return docs.select("doc_id", "text").mapInArrow(releasing(prefix), "token bigint, n bigint, key bigint")


def _cells(prefixes: DataFrame, partitions: int, chunk: int, percent: int) -> DataFrame:
    """(token, part, chunk, last, n, key): sets that share a token, by size, in chunks.

    A set without another of a size that could link to its own is dropped. A range partitioning
    by token, size and set cuts even a token that very many sets share into pieces for many
    tasks; what lies at a piece's end is kept, as its neighbours may be in the next one. `part`
    is the piece.
    """
    placed = prefixes.repartitionByRange(partitions, "token", "n", "key").sortWithinPartitions("token", "n", "key")
    marked = placed.withColumn("part", F.spark_partition_id())

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last row waits for what follows it; `before` is the row ahead of it. `at` and
        # `reached` are the token of the last row that went out and its weight so far.
        held, before, at, reached = None, None, None, 0

        def rows(columns: list[np.ndarray]) -> pa.RecordBatch:
            nonlocal at, reached
            token, n, key, part = columns
            starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            sizes = np.diff(np.concatenate([starts, [len(token)]]))
            weight = 1 + n // SET_WEIGHT
            ahead = np.cumsum(weight) - weight
            ahead -= np.repeat(ahead[starts], sizes)
            if at == token[0]:
                ahead[: sizes[0]] += reached
            at, reached = token[-1], int(ahead[-1] + weight[-1])
            return pa.RecordBatch.from_arrays(
                [pa.array(token), pa.array(part), pa.array((ahead // chunk).astype(np.int32)), pa.array(n), pa.array(key)],
                names=["token", "part", "chunk", "n", "key"],
            )

        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if held is not None:
                columns = [np.concatenate([h, c]) for h, c in zip(held, columns, strict=True)]
            token, _, key, _ = columns
            if not len(token):
                continue
            fresh = np.ones(len(token), dtype=bool)
            fresh[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
            columns = [c[fresh] for c in columns]
            token, n, _, _ = columns
            # Two neighbours in the order of sizes are near enough to link; then both may.
            near = (token[1:] == token[:-1]) & (100 * n[:-1] >= percent * n[1:])
            keep = np.zeros(len(token), dtype=bool)
            keep[1:] |= near
            keep[:-1] |= near
            if held is None or before == "first" or (before is not None and before[0] == token[0] and 100 * before[1] >= percent * n[0]):
                keep[0] = True
            if len(token) > 1:
                before = (token[-2], n[-2])
            elif held is None:
                before = "first"
            held = [c[-1:] for c in columns]
            keep[-1] = False
            if keep.any():
                yield rows([c[keep] for c in columns])
        if held is not None:
            yield rows(held)

    return marked.mapInArrow(releasing(pick), "token bigint, part int, chunk int, n bigint, key bigint")


class Node:
    """A node of a signature tree over some sets: OR of their bitmaps, range of their sizes."""

    __slots__ = ("bits", "children", "high", "low", "sets", "spare")

    def __init__(self, sets: range, children: list[Node], bits: int, low: int, high: int, spare: int) -> None:
        self.sets, self.children, self.bits, self.low, self.high, self.spare = sets, children, bits, low, high, spare


def build_tree(sizes: list[int], bitmaps: list[int], leaf: int = LEAF, fan: int = FAN) -> Node:
    """The tree over sets in their given order. `spare` is the most shingles of a set that share a bit."""
    level = []
    for start in range(0, len(sizes), leaf):
        sets = range(start, min(start + leaf, len(sizes)))
        bits = 0
        for i in sets:
            bits |= bitmaps[i]
        level.append(
            Node(sets, [], bits, min(sizes[i] for i in sets), max(sizes[i] for i in sets), max(sizes[i] - bitmaps[i].bit_count() for i in sets))
        )
    while len(level) > 1:
        above = []
        for start in range(0, len(level), fan):
            group = level[start : start + fan]
            bits = 0
            for node in group:
                bits |= node.bits
            above.append(
                Node(
                    range(group[0].sets.start, group[-1].sets.stop), group, bits,
                    min(g.low for g in group), max(g.high for g in group), max(g.spare for g in group),
                )
            )
        level = above
    return level[0]


def dual_traversal(
    sizes: list[int], bitmaps: list[bytes], percent: int, root: list[int], check: Callable[[int, int], bool] | None
) -> list[tuple[int, int]]:
    """A forest of pairs of sets, not connected by `root`, that may link; with `check`, that pass it.

    The sets must be ordered by size. Both sides go down the tree at once. A pair of nodes is
    left if its size ranges cannot link, if the common bits of its bitmaps allow too small an
    overlap, or if all its sets are connected already.
    """
    width = 8 * min(map(len, bitmaps))
    folded = [_folded(b, width) for b in bitmaps]

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def connected(a: range, b: range) -> bool:
        one = find(a[0])
        return all(find(i) == one for i in a) and all(find(i) == one for i in b)

    spare = [n - b.bit_count() for n, b in zip(sizes, folded, strict=True)]
    found = []
    top = build_tree(sizes, folded)
    work = [(top, top)]
    while work:
        a, b = work.pop()
        if a is not b:
            low, high = (a, b) if a.low <= b.low else (b, a)
            if 100 * low.high < percent * high.low:
                continue
            most = min(a.high, b.high, (a.bits & b.bits).bit_count() + max(a.spare, b.spare))
            if most * (100 + percent) < percent * (a.low + b.low):
                continue
        if connected(a.sets, b.sets):
            continue
        if a.children or b.children:
            if a is b:
                children = a.children
                work.extend((children[i], children[j]) for i in range(len(children)) for j in range(i + 1, len(children)))
                work.extend((c, c) for c in children)
            elif a.children and (not b.children or len(a.sets) >= len(b.sets)):
                work.extend((c, b) for c in a.children)
            else:
                work.extend((a, c) for c in b.children)
            continue
        for i in a.sets:
            for j in b.sets:
                if (a is not b or j > i) and find(i) != find(j):
                    most = (folded[i] & folded[j]).bit_count() + min(spare[i], spare[j])
                    if most * (100 + percent) < percent * (sizes[i] + sizes[j]):
                        continue
                    if check is None or check(i, j):
                        found.append((i, j))
                        root[find(i)] = find(j)
    return found


def _folded(bits: bytes, width: int) -> int:
    """A bitmap of a smaller power of two of bits: its parts, one over the other."""
    value = int.from_bytes(bits, "little")
    have = 8 * len(bits)
    while have > width:
        have //= 2
        value = (value >> have) | (value & ((1 << have) - 1))
    return value


def link_sets(sets: list[frozenset[int]], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that connect all sets whose Jaccard is at least percent / 100, as a forest."""
    order = sorted((i for i in range(len(sets)) if sets[i]), key=lambda i: (len(sets[i]), min(sets[i])))
    if not order:
        return []
    sizes = [len(sets[i]) for i in order]
    bitmaps = [bitmap(np.array(list(sets[i]), dtype=np.uint64)) for i in order]

    def check(i: int, j: int) -> bool:
        return len(sets[order[i]] & sets[order[j]]) * (100 + percent) >= percent * (sizes[i] + sizes[j])

    return [(order[i], order[j]) for i, j in dual_traversal(sizes, bitmaps, percent, list(range(len(order))), check)]


def _forest(groups: DataFrame, keys: list[str], percent: int, exact: bool) -> DataFrame:
    """(a, b): what is connected inside each group of `groups` (keys, n, key, root, content).

    `content` is a bitmap, by which sets may link, or with `exact` the whole set. Each connected
    set comes with the smallest key of its tree: stars, which need few rounds to be joined.
    """
    dealt = groups.select(F.xxhash64(*keys).alias("group"), "n", "key", "root", "content")
    dealt = dealt.repartition("group").sortWithinPartitions("group", "n", "key")

    def look(members: list[tuple]) -> pa.RecordBatch | None:
        sizes, names, roots, contents = ([m[i] for m in members] for i in range(4))
        at: dict[int, int] = {}
        root = [at.setdefault(r, i) for i, r in enumerate(roots)]
        if len(at) < 2:
            return None
        if exact:
            sets = [np.frombuffer(c, dtype=np.uint64) for c in contents]

            def check(i: int, j: int) -> bool:
                return _common(sets[i], sets[j]) * (100 + percent) >= percent * (sizes[i] + sizes[j])

            pairs = dual_traversal(sizes, [bitmap(s, EXACT_WIDEN) for s in sets], percent, root, check)
        else:
            pairs = dual_traversal(sizes, contents, percent, root, None)
        if not pairs:
            return None
        ends = _stars([(names[i], names[j]) for i, j in pairs])
        return pa.RecordBatch.from_arrays(
            [pa.array(list(ends.keys()), pa.int64()), pa.array(list(ends.values()), pa.int64())], names=["a", "b"]
        )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, members, seen = None, [], set()
        for batch in batches:
            contents = batch.column(4)
            for row, (group, n, key, root) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)):
                if group != current:
                    out = look(members) if len(members) > 1 else None
                    if out is not None:
                        yield out
                    current, members, seen = group, [], set()
                if key not in seen:
                    seen.add(key)
                    members.append((n, key, root, contents[row].as_py()))
        out = look(members) if len(members) > 1 else None
        if out is not None:
            yield out

    return dealt.mapInArrow(releasing(link), "a bigint, b bigint")


def _split_cells(cells: DataFrame, shapes: DataFrame, percent: int) -> DataFrame:
    """`cells` without the sets that can link to no other of their cell, and cut where no set can.

    The small bitmaps tell. Cells of several chunks stay as they are.
    """
    sizes = cells.groupBy("token").agg(F.max("chunk").alias("_chunks"), F.min("part").alias("_from"), F.max("part").alias("_to"))
    sized = cells.join(sizes, "token")
    large = sized.where("_chunks > 0 OR _from < _to").select(*cells.columns)
    small = sized.where("_chunks = 0 AND _from = _to").select("token", "n", "key").join(shapes.select("key", "thin").hint("merge"), "key")
    dealt = small.select("token", "n", "key", "thin").repartition("token").sortWithinPartitions("token", "n", "key")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def trees(token: int, members: dict[int, tuple]) -> list[tuple]:
            names = list(members)
            sizes, bitmaps = [members[k][0] for k in names], [members[k][1] for k in names]
            pairs = dual_traversal(sizes, bitmaps, percent, list(range(len(names))), None)
            ends = _stars([(names[i], names[j]) for i, j in pairs])
            ends |= {r: r for r in set(ends.values())}
            return [(token, root, members[k][0], k) for k, root in ends.items()]

        current, members, out = None, {}, []
        for batch in batches:
            for token, n, key, thin in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if token != current:
                    out += trees(current, members) if len(members) > 1 else []
                    current, members = token, {}
                members[key] = (n, thin)
            if out:
                yield rows(out)
                out = []
        out += trees(current, members) if len(members) > 1 else []
        if out:
            yield rows(out)

    def rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["token", "root", "n", "key"])

    fine = dealt.mapInArrow(releasing(split), "token bigint, root bigint, n bigint, key bigint").select(
        F.xxhash64("token", "root").alias("token"), F.lit(0).alias("part"), F.lit(0).alias("chunk"), "n", "key"
    )
    return large.unionByName(fine)


def _distinct_cells(cells: DataFrame) -> DataFrame:
    """One cell of those that hold the same sets; cells of one set hold no link."""
    kinds = cells.groupBy("token").agg(
        F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("key")).alias("mark"), F.bit_xor(F.xxhash64("key", F.lit(1))).alias("mark2")
    )
    chosen = kinds.where("m > 1").groupBy("m", "mark", "mark2").agg(F.min("token").alias("token"))
    return cut_lineage(cells.join(chosen.select("token"), "token", "left_semi"))


def _stars(pairs: list[tuple[int, int]]) -> dict[int, int]:
    """Every name of the pairs but the smallest of its tree, with that."""
    low: dict[int, int] = {}

    def find(x: int) -> int:
        while low.setdefault(x, x) != x:
            low[x] = low[low[x]]
            x = low[x]
        return x

    for a, b in pairs:
        one, two = sorted((find(a), find(b)))
        low[two] = one
    return {x: find(x) for x in list(low) if find(x) != x}


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """How many members two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def _connected(cells: DataFrame, contents: DataFrame, percent: int, exact: bool) -> DataFrame:
    """(key, root): sets connected by the pairs of all cells (token, part, chunk, n, key).

    Every chunk is looked at together with the one after it; chunks further apart only where the
    sets of their token are not all connected by then.
    """
    at = F.when(F.col("chunk") > 0, F.array(F.col("chunk") - 1, F.col("chunk"))).otherwise(F.array("chunk"))
    near = cells.withColumn("at", F.explode(at)).withColumn("root", F.col("key"))
    # The contents are large and the cells are not, but neither has a bound.
    with batches_of(cells.sparkSession, SET_ROWS):
        links = cut_lineage(_forest(near.join(contents.hint("merge"), "key"), ["token", "part", "at"], percent, exact))
    roots = cut_lineage(connected_components(links).withColumnRenamed("node", "key"))
    several = (
        cells.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key")).groupBy("token")
        .agg(F.min("root").alias("one"), F.max("root").alias("other"), F.max("chunk").alias("chunks"), F.min("part").alias("from"), F.max("part").alias("to"))
        .where("one <> other AND (chunks > 1 OR `from` < `to`)").select("token")
    )
    named = cut_lineage(cells.join(several, "token", "left_semi").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key")))
    lines = named.groupBy("token", "part", "chunk").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    other = lines.select("token", *[F.col(c).alias(c + "2") for c in ("part", "chunk", "low", "high")])
    apart = (F.col("part") < F.col("part2")) | ((F.col("part") == F.col("part2")) & (F.col("chunk") + 1 < F.col("chunk2")))
    far = cut_lineage(lines.join(other, "token").where(apart & (100 * F.col("high") >= percent * F.col("low2"))))
    if not far.limit(1).count():
        return roots
    far = far.withColumn("pair", F.struct("part", "chunk", "part2", "chunk2"))
    sides = F.explode(F.array(F.struct("part", "chunk"), F.struct(F.col("part2").alias("part"), F.col("chunk2").alias("chunk"))))
    seats = far.select("token", "pair", sides.alias("side")).select("token", "pair", "side.part", "side.chunk")
    further = seats.join(named, ["token", "part", "chunk"]).join(contents.hint("merge"), "key")
    with batches_of(cells.sparkSession, SET_ROWS):
        more = cut_lineage(_forest(further, ["token", "pair"], percent, exact))
    return cut_lineage(connected_components(links.unionByName(more)).withColumnRenamed("node", "key"))


class KeyFilter:
    """A Bloom filter of bounded size: `columns` to add to a table, `probe` to use in its tasks."""

    def __init__(self, keys: DataFrame, column: str) -> None:
        places = keys.select(F.xxhash64(column).alias("h"))
        count = places.count()
        self.bits = 1 << min(max(10, (FILTER_BITS * count).bit_length()), MAX_FILTER_BITS.bit_length() - 1)
        # One row for 64 bits of the filter; their number is bounded by its size.
        blocks = places.select(F.explode(F.array(*self._places(F.col("h")))).alias("bit"))
        blocks = blocks.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("value"))
        table = blocks.toArrow()
        filled = np.zeros(self.bits // 64, dtype=np.uint64)
        filled[table.column(0).to_numpy()] = table.column(1).to_numpy().view(np.uint64)
        self.shared = keys.sparkSession.sparkContext.broadcast(filled)

    def _places(self, h: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(h, F.lit(i)), F.lit(self.bits)) for i in range(3)]

    def columns(self, column: str, names: Sequence[str] = ("_bit0", "_bit1", "_bit2")) -> list[Column]:
        return [c.alias(name) for c, name in zip(self._places(F.xxhash64(F.col(f"`{column}`"))), names, strict=True)]

    @staticmethod
    def probe(words: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
        """Which rows may be among the keys; the filter's columns are the batch's last ones."""
        wanted = np.ones(batch.num_rows, dtype=bool)
        for column in batch.columns[-3:]:
            bit = column.to_numpy()
            wanted &= (words[bit // 64] >> (bit % 64).astype(np.uint64)) & np.uint64(1) == 1
        return wanted


def _one_document_each(keys: DataFrame, profiles: DataFrame) -> KeyFilter:
    """The filter of one document for each set of `keys`."""
    chosen = profiles.select("key", "doc_id").join(keys, "key", "left_semi").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    return KeyFilter(chosen, "doc_id")


def _shapes_of(keys: DataFrame, profiles: DataFrame) -> DataFrame:
    """(key, n, bits, thin) of the sets of `keys`, and of a few others, without shuffling any."""
    named = _one_document_each(keys, profiles)
    shared, probe = named.shared, KeyFilter.probe

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.filter(pa.array(probe(shared.value, batch)))
            if kept.num_rows:
                yield kept.select(["key", "n", "bits", "thin"])

    rows = profiles.where("key IS NOT NULL").select("key", "n", "bits", "thin", *named.columns("doc_id"))
    return cut_lineage(rows.mapInArrow(releasing(pick), "key bigint, n bigint, bits binary, thin binary"))


def _sets_of(keys: DataFrame, docs: DataFrame, profiles: DataFrame, width: int) -> DataFrame:
    """(key, content): the shingle sets named by `keys`, each from one document's text.

    The documents are picked by a filter of bounded size, which is broadcast, so that the texts
    need not be shuffled; a few more than asked for pass it.
    """
    named = _one_document_each(keys, profiles)
    shared, probe = named.shared, KeyFilter.probe

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = probe(shared.value, batch)
            if wanted.any():
                for part in slices(batch.filter(pa.array(wanted))):
                    _, hashes, size, key = shingle_sets(part, width)
                    ends = np.concatenate([[0], np.cumsum(size)]).tolist()
                    tokens = [hashes[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([_signed(key), pa.array(tokens, pa.binary())], names=["key", "content"])

    return docs.select("doc_id", "text", *named.columns("doc_id")).mapInArrow(releasing(sets), "key bigint, content binary")


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT, chunk: int = CHUNK
) -> DataFrame:
    """(doc_id, n_shingles, component_id): groups of documents whose shingle sets link.

    A set holds the distinct runs of `width` words (A-Z lower-cased), or the whole of a shorter
    text; NULL and blank texts have an empty set and stand alone. Sets are compared by 64-bit
    hashes. Equal sets are one node from the start, so copies are never paired. Linked sets
    share one of their rarest shingles; sets that do form a cell, in which the dual traversal of
    a signature tree finds, by bitmaps, what may link. Sets connected that way then meet once
    with all their shingles, and another traversal compares them exactly. Cells of the same sets
    are worked on once. `component_id` is the smallest
    id reachable by links. Repeated rows share their result; rows without an id take part under
    NULL; an empty table gives none.
    """
    profiles, named = _components(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), width, percent, chunk)
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    member = named.join(lowest, "root").select("key", "component_id")
    shown = profiles.where("key IS NOT NULL").join(member, "key")
    alone = profiles.where("key IS NULL").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    return shown.select(*columns).unionByName(alone.select(*columns))


def _components(rows: DataFrame, width: int, percent: int, chunk: int) -> tuple[DataFrame, DataFrame]:
    """((doc_id, n, key) of every document, (key, first, root) of every set); root names the set's component."""
    spark = rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with batches_of(spark, TEXT_ROWS):
        profiles = cut_lineage(_profiles(rows, width))
    sketch = _sketch(profiles)
    profiles = profiles.where("block IS NULL").select("doc_id", "n", "key", "bits", "thin")
    with batches_of(spark, 10 * TEXT_ROWS):
        cells = cut_lineage(_cells(_prefixes(rows, sketch, width, percent), partitions, chunk, percent))

    # Cells whose sets are the same need one look, before and after they are cut.
    cells = _distinct_cells(cells)
    shapes = _shapes_of(cells.select("key").distinct(), profiles)
    cells = _distinct_cells(cut_lineage(_split_cells(cells, shapes, percent)))

    # What the bitmaps allow to be connected holds all links; there the whole sets are compared.
    maybe = _connected(cells, shapes.select("key", F.col("bits").alias("content")), percent, exact=False)
    tied = maybe.select(F.col("root").alias("token"), "key").unionByName(maybe.select(F.col("root").alias("token"), F.col("root").alias("key")))
    tied = shapes.select("key", "n").distinct().join(tied.distinct(), "key").select("token", "n", "key")
    tied = cut_lineage(_cells(tied, partitions, chunk, percent))
    sets = _sets_of(cut_lineage(tied.select("key").distinct()), rows, profiles, width)
    roots = _connected(tied, sets, percent, exact=True)

    least = profiles.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("first"))
    named = cut_lineage(least.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key")))
    return profiles.select("doc_id", "n", "key"), named


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT, chunk: int = CHUNK
) -> DataFrame:
    """`docs` with one row of each group of linked texts: that of the group's smallest id.

    Decided by row, not by id: if an id stands on two texts, each of them goes or stays with its
    own group. Of a group's rows with the smallest id the first by shingle set and text stays.
    Rows without an id and rows without words all stay. Only rows whose id is among those of rows
    that may go are looked at again: a filter of bounded size lets the others pass, and texts
    are shuffled for the one row of a group only.
    """
    spark = docs.sparkSession
    known = docs.where(F.col(f"`{id_col}`").isNotNull())
    profiles, named = _components(known.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), width, percent, chunk)
    members = profiles.where("key IS NOT NULL").groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n"))
    members = cut_lineage(look_up(members, _weighed(named, members), ["key"], "weight", members.count()))
    groups = members.groupBy("root").agg(F.sum("n").alias("rows"), F.min(F.struct("doc_id", "key")).alias("stays")).where("rows > 1")
    several = cut_lineage(
        named.join(groups, "root").select("key", "root", F.col("stays.doc_id").alias("stay_id"), F.col("stays.key").alias("stay_key"))
    )
    judged = look_up(members.select("doc_id", "key", "n"), _weighed(several, members), ["key"], "weight", members.count())
    goes = (F.col("doc_id") != F.col("stay_id")) | (F.col("key") != F.col("stay_key")) | (F.col("n") > 1)
    doubtful = KeyFilter(cut_lineage(judged.where(F.col("root").isNotNull() & goes).select("doc_id").distinct()), "doc_id")
    shared, probe = doubtful.shared, KeyFilter.probe

    names = docs.columns
    mark_name, key_name, *bits = free_names(docs, "_doubtful", "_key", "_bit0", "_bit1", "_bit2")
    place = names.index(text_col)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = probe(shared.value, batch)
            for part, marks in _with_marks(batch.select(list(range(len(names)))), seen, place):
                keys = np.zeros(part.num_rows, dtype=np.uint64)
                empty = np.ones(part.num_rows, dtype=bool)
                rows = np.flatnonzero(marks)
                if len(rows):
                    texts = pa.RecordBatch.from_arrays([part.column(place).take(pa.array(rows))], names=["text"])
                    _, _, size, key = shingle_sets(texts, width)
                    keys[rows], empty[rows] = key, size == 0
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(marks), pa.array(keys.view(np.int64), mask=empty)], names=[*names, mark_name, key_name]
                )

    schema = StructType([*docs.schema.fields, StructField(mark_name, BooleanType()), StructField(key_name, LongType())])
    with batches_of(spark, TEXT_ROWS):
        marked = docs.select("*", *doubtful.columns(id_col, bits)).mapInArrow(releasing(mark), schema)
    there = F.col(mark_name) & F.col(f"`{id_col}`").isNotNull() & F.col(key_name).isNotNull()
    table = _weighed(several, members).withColumnRenamed("key", key_name)
    group, stay_id, stay_key, row = free_names(marked, "_root", "_stay_id", "_stay_key", "_row")
    table = table.withColumnsRenamed({"root": group, "stay_id": stay_id, "stay_key": stay_key})
    chosen = (F.col(f"`{id_col}`") == F.col(stay_id)) & (F.col(key_name) == F.col(stay_key))
    held = look_up(marked.where(there), table, [key_name], "weight", members.count())
    held = cut_lineage(held.where(F.col(group).isNull() | chosen))
    free = held.where(F.col(group).isNull()).select(*[F.col(f"`{c}`") for c in names])
    whole = F.struct(*[F.col(f"`{c}`") for c in names])
    one = held.where(F.col(group).isNotNull()).groupBy(group).agg(F.min_by(whole, F.col(f"`{text_col}`")).alias(row)).select(f"{row}.*")
    passed = marked.where(~F.coalesce(there, F.lit(False))).select(*[F.col(f"`{c}`") for c in names])
    return passed.union(free).union(one)


def _weighed(sets: DataFrame, members: DataFrame) -> DataFrame:
    """`sets` with `weight`: in how many rows of `members` (doc_id, key, n) each one's key stands."""
    return sets.drop("first").join(members.groupBy("key").agg(F.count(F.lit(1)).alias("weight")), "key")


def _with_marks(batch: pa.RecordBatch, marks: np.ndarray, place: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The batch in slices of bounded text, each with its part of the marks."""
    at = 0
    for part in slices(batch.rename_columns([f"c{i}" for i in range(batch.num_columns)]), f"c{place}"):
        yield part, marks[at : at + part.num_rows]
        at += part.num_rows
