"""SimHash fingerprints of documents, of edited documents, and the search for near ones."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.skew import look_up
from lexmill.llm.textkit import mix64, slices, words_of
from lexmill.session import cut_lineage

BITS = 128
# Terms are runs of so many words.
TERM_WORDS = 2
# Near copies lie within so many bits: on sf0.1, 95% of texts with one word changed, 87% with 1% of the words.
RADIUS = 10
# Ranges of ids for each shuffle partition, and at most; their bounds are known to the driver.
RANGES_PER_PARTITION = 4
MAX_RANGES = 20_000

# Fingerprints of a cell that are compared in one group; blocks that a table looks at, at most; what
# comparing a pair costs, in rows of a table.
CHUNK = 2_048
MOST_BLOCKS = 4
PAIR_COST = 0.0025
# In a group of one chunk every pair counts.
BOTH = 2

_LANE = np.uint64(0xD1B54A32D192ED03)


def simhash(part: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray]:
    """The two 64-bit halves of each text's fingerprint.

    Every distinct term votes with the bits of its hash, for a one or against it, as heavily as
    one plus the logarithm of its count (in sixteenths, so that sums are exact). A bit is one if
    the votes for it prevail. A text without words has fingerprint 0.
    """
    doc, hashes = words_of(part, text).shingles(TERM_WORDS)
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    high, low = np.zeros(part.num_rows, dtype=np.uint64), np.zeros(part.num_rows, dtype=np.uint64)
    if not len(doc):
        return high, low
    fresh = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])]))
    counts = np.diff(np.concatenate([fresh, [len(doc)]]))
    doc, hashes = doc[fresh], hashes[fresh]
    weight = np.round(16.0 * (1.0 + np.log(counts)))
    lanes = np.stack([hashes, mix64(hashes + _LANE)], axis=1).astype(">u8").view(np.uint8).reshape(-1, BITS // 8)
    starts = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=part.num_rows))])
    for i in range(part.num_rows):
        a, b = starts[i], starts[i + 1]
        if a < b:
            votes = weight[a:b] @ np.unpackbits(lanes[a:b], axis=1).astype(np.float64)
            packed = np.packbits(2.0 * votes > weight[a:b].sum()).view(">u8")
            high[i], low[i] = packed[0], packed[1]
    return high, low


def add_fingerprints(rows: DataFrame, texts: dict[str, str]) -> DataFrame:
    """`rows` without the named text columns, with two halves `<name>_high`, `<name>_low` for each."""
    keep = [f for f in rows.schema if f.name not in texts]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, next(iter(texts))):
                columns = {f.name: part.column(part.schema.names.index(f.name)) for f in keep}
                for text, name in texts.items():
                    for half, values in zip(("high", "low"), simhash(part, text), strict=True):
                        columns[f"{name}_{half}"] = pa.array(values.view(np.int64), pa.int64())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in keep]
    fields += [f"{name}_{half} bigint" for name in texts.values() for half in ("high", "low")]
    return rows.mapInArrow(add, ", ".join(fields))


def shown(high: Column, low: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def distance(high: Column, low: Column, high2: Column, low2: Column) -> Column:
    """Number of bits in which two fingerprints differ."""
    return F.bit_count(high.bitwiseXOR(high2)) + F.bit_count(low.bitwiseXOR(low2))


def tables_for(count: int, radius: int) -> list[tuple[int, ...]]:
    """The blocks that each table looks at, for so many fingerprints.

    With radius + k blocks, two fingerprints within the radius agree in k of them at least, so
    one table for each k blocks misses none. A larger k means more tables, that is more rows, and
    smaller cells, that is fewer comparisons; the cheapest is taken. Results do not depend on it.
    """
    def cost(k: int) -> float:
        return math.comb(radius + k, k) * (1.0 + PAIR_COST * count / 2.0 ** (BITS * k / (radius + k)))

    best = min(range(1, MOST_BLOCKS + 1), key=cost)
    return list(combinations(range(radius + best), best))


def _masks(blocks: int) -> list[tuple[np.uint64, np.uint64]]:
    """The (high, low) masks of so many consecutive blocks of bits."""
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    whole = [(1 << BITS - a) - (1 << BITS - b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return [(np.uint64(mask >> 64), np.uint64(mask & (1 << 64) - 1)) for mask in whole]


def _in_tables(members: DataFrame, tables: list[tuple[int, ...]], blocks: int) -> DataFrame:
    """(cell, high, low, members): every fingerprint in each table; the cell's last 16 bits are the table's number."""
    masks = _masks(blocks)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                high, low = (part.column(i).to_numpy().view(np.uint64) for i in (0, 1))
                for number, table in enumerate(tables):
                    both = [np.bitwise_or.reduce([masks[b][half] for b in table]) for half in (0, 1)]
                    cell = mix64(mix64((high & both[0]) + _LANE) ^ (low & both[1])) & ~np.uint64(0xFFFF) | np.uint64(number)
                    yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), *part.columns], names=["cell", "high", "low", "members"])

    return members.select("high", "low", "members").mapInArrow(deal, "cell bigint, high bigint, low bigint, members bigint")


def near_in_groups(
    group: np.ndarray, table: np.ndarray, side: np.ndarray, high: np.ndarray, low: np.ndarray, tables: list[tuple[int, ...]], blocks: int, radius: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, row, bits) of the pairs of one group that are near and first met in its table.

    Rows are sorted by group; all groups are worked on at once, each row against the one so many
    places further on. `side` tells the two chunks of a group apart, of which only pairs across
    count, or is BOTH. A pair counts in the table of the first blocks in which it agrees.
    """
    masks = _masks(blocks)
    last = np.array([t[-1] for t in tables])
    found: list[tuple[np.ndarray, ...]] = []
    rows, step = np.arange(len(group) - 1), 1
    while len(rows):
        rows = rows[rows + step < len(group)]
        rows = rows[group[rows] == group[rows + step]]
        other = rows + step
        apart_high, apart_low = high[rows] ^ high[other], low[rows] ^ low[other]
        bits = np.bitwise_count(apart_high) + np.bitwise_count(apart_low)
        near = (bits <= radius) & ((side[rows] == BOTH) | (side[rows] != side[other]))
        if near.any():
            one, two = rows[near], other[near]
            agree = np.stack([((apart_high[near] & a) == 0) & ((apart_low[near] & b) == 0) for a, b in masks])
            own = table[one]
            here = np.ones(len(one), dtype=bool)
            for k in range(len(tables[0])):
                here &= agree[np.array([t[k] for t in tables])[own], np.arange(len(one))]
            before = (agree & (np.arange(blocks)[:, None] < last[own][None, :])).sum(axis=0)
            here &= before == len(tables[0]) - 1
            found.append((one[here], two[here], bits[near][here]))
        step += 1
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _compared(members: DataFrame, radius: int, pairs: bool, chunk: int) -> DataFrame:
    """Partial counts (high, low, others) of near rows, or the pairs (high, low, high2, low2, bits) themselves.

    The fingerprints of a cell are compared inside a task; a cell of more than `chunk` is cut into
    chunks, and each two of them are a group of their own. Without `pairs` no pair is ever a row.
    """
    count = members.count()
    tables = tables_for(count, radius)
    blocks = radius + len(tables[0])
    seats = _in_tables(members, tables, blocks)
    crowded = seats.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk)
    crowded = cut_lineage(crowded.withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int")))
    dealt = look_up(seats, crowded, ["cell"], "n", count * len(tables)).withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("high", "low"), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    two = F.greatest("own", "with")
    # Cells keep their table in the last bits, so do groups.
    group = F.xxhash64("cell", F.least("own", "with"), two).bitwiseAND(F.lit(~0xFFFF)).bitwiseOR(F.col("cell").bitwiseAND(F.lit(0xFFFF)))
    side = F.when(F.col("own") == F.col("with"), F.lit(BOTH)).otherwise((F.col("own") == two).cast("int"))
    groups = dealt.select(F.when(F.col("chunks") > 1, group).otherwise(F.col("cell")).alias("group"), "high", "low", "members", side.alias("side"))
    groups = groups.repartition("group").sortWithinPartitions("group", "high", "low")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def out(columns: list[np.ndarray]) -> pa.RecordBatch | None:
            group, high, low, weight, side = columns
            table = (group & 0xFFFF).astype(np.int64)
            one, two, bits = near_in_groups(group, table, side, high.view(np.uint64), low.view(np.uint64), tables, blocks, radius)
            if not len(one):
                return None
            if pairs:
                turned = (high[one] > high[two]) | ((high[one] == high[two]) & (low[one] > low[two]))
                one, two = np.where(turned, two, one), np.where(turned, one, two)
                columns = [high[one], low[one], high[two], low[two]]
                return pa.RecordBatch.from_arrays(
                    [*map(pa.array, columns), pa.array(bits.astype(np.int32))], names=["high", "low", "high2", "low2", "bits"]
                )
            others = np.bincount(one, weights=weight[two], minlength=len(group)) + np.bincount(two, weights=weight[one], minlength=len(group))
            some = np.flatnonzero(others)
            return pa.RecordBatch.from_arrays(
                [pa.array(high[some]), pa.array(low[some]), pa.array(others[some].astype(np.int64))], names=["high", "low", "others"]
            )

        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now, strict=True)]
            # The last group may go on in the next batch.
            cut = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0
            made = out([c[:cut] for c in now])
            if made is not None:
                yield made
            held = [c[cut:] for c in now]
        if held is not None:
            made = out(held)
            if made is not None:
                yield made

    shape = "high bigint, low bigint, high2 bigint, low2 bigint, bits int" if pairs else "high bigint, low bigint, others bigint"
    return groups.mapInArrow(link, shape)


def near_pairs(fingerprints: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """(high, low, high2, low2, bits): all pairs of different fingerprints within `radius` bits, each once.

    `fingerprints` has distinct (high, low).
    """
    return _compared(fingerprints.select("high", "low", F.lit(1).cast("bigint").alias("members")), radius, True, chunk)


def near_counts(prints: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """(high, low, copies, n_near): for each fingerprint its rows, and how many other rows lie within `radius` bits."""
    members = cut_lineage(prints.groupBy("high", "low").agg(F.count(F.lit(1)).alias("members")))
    linked = _compared(members, radius, False, chunk).groupBy("high", "low").agg(F.sum("others").alias("linked"))
    return members.join(linked, ["high", "low"], "left").select(
        "high", "low", F.col("members").alias("copies"), (F.col("members") - 1 + F.coalesce("linked", F.lit(0))).cast("bigint").alias("n_near")
    )


def in_id_ranges(rows: DataFrame, partitions: int) -> DataFrame:
    """`rows` with `range` and `guest`: ranges of descending ids, each followed by the next one's first row.

    The bounds are approximate quantiles of the ids. The last range is followed by the first
    row of all. Rows without an id come last.
    """
    ranges = min(max(1, RANGES_PER_PARTITION * partitions), MAX_RANGES)
    found = rows.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.25 / ranges) if ranges > 1 else []
    splits = [-math.inf, *(sorted(set(found)) or [0.0]), math.inf]
    cut = Bucketizer(splits=splits, inputCol="_id", outputCol="_range", handleInvalid="keep")
    placed = cut.transform(rows.withColumn("_id", F.col("doc_id").cast("double")))
    # Bucket 0 has the smallest ids and a missing id the last number; the order is descending.
    number = F.when(F.col("doc_id").isNull(), F.lit(len(splits))).otherwise(len(splits) - F.col("_range")).cast("int")
    placed = placed.withColumn("range", number).drop("_id", "_range")
    # One row per range.
    heads = sorted(tuple(r) for r in placed.groupBy("range").agg(F.max("doc_id")).collect())
    guests = [(heads[i][0], heads[i - 1][0]) for i in range(len(heads))]
    # The first row of range i is the guest of the one before; a range alone is its own guest.
    listed = rows.sparkSession.createDataFrame(
        [(r, g, h) for (r, g), (_, h) in zip(guests, heads, strict=True)], f"range int, host int, head {rows.schema['doc_id'].dataType.simpleString()}"
    )
    listed = listed.select(F.col("range").alias("_r"), "host", "head")
    first = (F.col("range") == F.col("_r")) & F.col("doc_id").eqNullSafe(F.col("head"))
    seats = F.when(
        F.col("host").isNotNull(),
        F.array(F.struct(F.col("range").alias("r"), F.lit(False).alias("g")), F.struct(F.col("host").alias("r"), F.lit(True).alias("g"))),
    ).otherwise(F.array(F.struct(F.col("range").alias("r"), F.lit(False).alias("g"))))
    joined = placed.join(F.broadcast(listed), first, "left").withColumn("seat", F.explode(seats))
    return joined.select(*rows.columns, F.col("seat.r").alias("range"), F.col("seat.g").alias("guest"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and their likeness.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next (share of equal bits) and n_near (other documents within `radius` bits). The
    edited text has its last third replaced by the beginning of the next document's, in
    descending order of integer ids, rows without an id last, equal ids by text; the last is
    followed by the first, a single document by itself. NULL counts as empty; an empty text is
    its own edit. Texts are shuffled once, in ranges of ids whose number grows with the
    partitions; each range also gets the first row of the next.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = Window.partitionBy("range").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    placed = in_id_ranges(rows, partitions).select("*", F.row_number().over(line).alias("place"), F.lead("text").over(line).alias("next"))
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - third), F.substring(F.coalesce("next", F.lit("")), F.lit(1), third)
    )
    texts = placed.select(
        "doc_id", "range", "guest", "place", F.length("text").cast("bigint").alias("n_chars"), "text",
        F.when(F.col("guest"), F.lit("")).otherwise(edited).alias("edited"),
    ).withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    made = cut_lineage(add_fingerprints(texts, {"text": "own", "edited": "edited"}))
    follow = Window.partitionBy("range").orderBy("place")
    made = made.select("*", F.lead("own_high").over(follow).alias("next_high"), F.lead("own_low").over(follow).alias("next_low"))
    own = made.where(~F.col("guest"))
    near = cut_lineage(near_counts(own.select(F.col("own_high").alias("high"), F.col("own_low").alias("low")), radius))
    near = near.withColumnsRenamed({"high": "own_high", "low": "own_low"})
    likeness = lambda high, low: 1.0 - distance(F.col("own_high"), F.col("own_low"), F.col(high), F.col(low)) / float(BITS)
    return (
        look_up(own, near, ["own_high", "own_low"], "copies", own.count())
        .select(
            "doc_id", "n_chars", "edited_sha256",
            shown(F.col("own_high"), F.col("own_low")).alias("fingerprint"),
            shown(F.col("edited_high"), F.col("edited_low")).alias("edited_fingerprint"),
            likeness("edited_high", "edited_low").alias("near_edited"),
            likeness("next_high", "next_low").alias("near_next"),
            "n_near",
        )
    )
