"""Product codes of vectors: integer codebooks refined in rounds, entries found by equal-average search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from lexmill.llm.skew import look_up
from lexmill.session import cut_lineage, spread

SCALE = 4_096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
# Integer components times the vector's length stay below this, so that squares of sums fit 64 bits.
MOST_SUM = 1 << 30

Codebooks = dict[int, list[np.ndarray]]


def bounds(length: int, parts: int) -> list[tuple[int, int]]:
    """Where each of the consecutive parts begins and ends; they are equal if `parts` divides the length."""
    cuts = [p * length // parts for p in range(parts + 1)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def nearest_entries(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of the entry nearest to each point, ties to the lower index.

    Entries are sorted by the sum of their components. From a point's own sum the search goes
    outward to both sides; the squared gap of two sums is at most the dimension times the squared
    distance, so a side ends once its gap, squared and divided by the dimension, exceeds the best
    distance. It goes on while they are equal, since an entry there may tie with a lower index.
    """
    width, count = points.shape[1], len(book)
    order = np.argsort(book.sum(axis=1), kind="stable")
    sums = book.sum(axis=1)[order]
    own = points.sum(axis=1)
    best = np.full(len(points), (1 << 62) // max(width, 1), dtype=np.int64)
    entry = np.full(len(points), count, dtype=np.int64)
    above = np.searchsorted(sums, own)
    sides = [(np.arange(len(points)), above - 1, -1), (np.arange(len(points)), above, 1)]
    while any(len(rows) for rows, _, _ in sides):
        onward = []
        for rows, at, step in sides:
            inside = (at >= 0) & (at < count)
            rows, at = rows[inside], at[inside]
            gap = sums[at] - own[rows]
            near = gap * gap <= best[rows] * width
            rows, at = rows[near], at[near]
            apart = points[rows] - book[order[at]]
            found, name = (apart * apart).sum(axis=1), order[at]
            better = (found < best[rows]) | ((found == best[rows]) & (name < entry[rows]))
            best[rows[better]], entry[rows[better]] = found[better], name[better]
            onward.append((rows, at + step, step))
        sides = onward
    return entry, best


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for the vectors of each length in a list column; NULL components become NaN in floats."""
    there = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    lengths = column.value_lengths().take(pa.array(there)).to_numpy(zero_copy_only=False) if len(there) else there
    for length in np.unique(lengths).tolist():
        rows = there[lengths == length]
        flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        yield rows, flat.reshape(len(rows), int(length))


def _integers(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """(id, label, vector) with the vector's components as integers, without the rows that are dropped."""
    for batch in batches:
        for rows, matrix in _by_length(batch.column(2)):
            with np.errstate(over="ignore", invalid="ignore"):
                scaled = np.floor(matrix.astype(np.float64) * scale)
                fits = (np.abs(scaled) * max(matrix.shape[1], 1) < MOST_SUM).all(axis=1)
            rows, whole = pa.array(rows[fits]), scaled[fits].astype(np.int32)
            offsets = pa.array(np.arange(len(whole) + 1, dtype=np.int32) * matrix.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(whole.ravel(), pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), lists], names=["id", "label", "x"])


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """(id, label, x array<int>): floor(scale * component) of the vectors that can be coded."""
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").alias("vector"))
    kind = rows.schema["vector"].dataType
    if not (isinstance(kind, ArrayType) and isinstance(kind.elementType, (FloatType, DoubleType))):
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    names = f"id {rows.schema['id'].dataType.simpleString()}, label {rows.schema['label'].dataType.simpleString()}, x array<int>"
    return spread(rows).mapInArrow(lambda batches: _integers(batches, scale), names)


def first_codebooks(whole: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """For each length of vector the parts of the `entries` rows with the smallest ids, ascending.

    One job for each length in the table; NULL ids come last, equal ids by their vectors.
    """
    lengths = [r["n"] for r in whole.groupBy(F.size("x").alias("n")).agg(F.count(F.lit(1))).collect()]
    books = {}
    for length in sorted(lengths):
        rows = whole.where(F.size("x") == length).orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
        first = np.array([r["x"] for r in rows], dtype=np.int64).reshape(len(rows), length)
        books[length] = [first[:, a:b] for a, b in bounds(length, parts)]
    return books


def _sums(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[pa.RecordBatch]:
    """(length, part, entry, place, total, n): one row per component of every entry that has parts in this task."""
    parts = {n: bounds(n, len(b)) for n, b in books.items()}
    totals = {n: [np.zeros((b.shape[0], b.shape[1] + 1), dtype=np.int64) for b in own] for n, own in books.items()}
    for batch in batches:
        for _, matrix in _by_length(batch.column(0)):
            length, whole = matrix.shape[1], matrix.astype(np.int64)
            for (a, b), book, total in zip(parts[length], books[length], totals[length], strict=True):
                points = whole[:, a:b]
                entry, _ = nearest_entries(points, book)
                order = np.argsort(entry, kind="stable")
                used, heads, counts = np.unique(entry[order], return_index=True, return_counts=True)
                if b > a:
                    total[used, :-1] += np.add.reduceat(points[order], heads, axis=0)
                total[used, -1] += counts
    for length, own in totals.items():
        for part, total in enumerate(own):
            entry = np.flatnonzero(total[:, -1])
            width = total.shape[1] - 1
            if len(entry) and width:
                size = len(entry) * width
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(size, length, dtype=np.int32)),
                        pa.array(np.full(size, part, dtype=np.int32)),
                        pa.array(np.repeat(entry, width).astype(np.int32)),
                        pa.array(np.tile(np.arange(width, dtype=np.int32), len(entry))),
                        pa.array(total[entry, :-1].ravel()),
                        pa.array(np.repeat(total[entry, -1], width)),
                    ],
                    names=["length", "part", "entry", "place", "total", "n"],
                )


def refine(whole: DataFrame, books: Codebooks, rounds: int = ROUNDS) -> Codebooks:
    """The codebooks after so many rounds of assigning all parts and taking floors of means.

    Every task sums its own parts; what is shuffled has a row per component of a codebook and
    task. The driver gets and sends the codebooks, `entries` times the length of a vector. Rounds
    after one that changes nothing would change nothing either.
    """
    spark = whole.sparkSession
    for _ in range(rounds if books else 0):
        shared = spark.sparkContext.broadcast(books)
        sums = whole.select("x").mapInArrow(
            lambda batches, shared=shared: _sums(batches, shared.value), "length int, part int, entry int, place int, total bigint, n bigint"
        )
        merged = sums.groupBy("length", "part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
        fresh = {length: [b.copy() for b in own] for length, own in books.items()}
        for r in merged:
            fresh[r["length"]][r["part"]][r["entry"], r["place"]] = r["total"] // r["n"]
        shared.unpersist()
        if all((a == b).all() for length in books for a, b in zip(books[length], fresh[length], strict=True)):
            break
        books = fresh
    return books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and place, as decimals joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def _codes(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, matrix in _by_length(batch.column(2)):
            length, whole = matrix.shape[1], matrix.astype(np.int64)
            names = np.zeros((len(whole), len(books[length])), dtype=np.uint8)
            error = np.zeros(len(whole), dtype=np.int64)
            for p, ((a, b), book) in enumerate(zip(bounds(length, len(books[length])), books[length], strict=True)):
                entry, apart = nearest_entries(whole[:, a:b], book)
                names[:, p] = entry
                error += apart
            text, step = names.tobytes().hex(), 2 * names.shape[1]
            codes = [text[i : i + step] for i in range(0, len(text), step)]
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(np.full(len(whole), length, dtype=np.int32)), pa.array(codes, pa.string()), pa.array(error)],
                names=["id", "label", "length", "code", "error"],
            )


def compress_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): one row per vector that can be coded.

    Components become integers, floor(scale * x); all further arithmetic is in integers, so
    results do not depend on how rows are dealt out. `entries` is at most 256, two hex digits.
    Vectors that are NULL or hold NULL or non-finite components are dropped, and so are those
    with a component of which `scale * |x| * length` reaches 2^30 (|x| of 4,096 for 64 components
    at a scale of 4,096), whose squares would not fit 64 bits. Vectors of each length have their
    own codebooks and digest; a length that `parts` does not divide is cut as evenly as it can
    be. With fewer rows than entries there are as many entries as rows. Repeated rows repeat
    their result and weigh as often; NULL ids come last among the first entries. Errors of NULL
    labels are summed together. A sum that does not fit 64 bits is NULL. An empty table gives
    none. Other columns are not looked at.
    """
    whole = cut_lineage(whole_vectors(vectors, id_col, vector_col, label_col, scale))
    books = refine(whole, first_codebooks(whole, parts, entries), rounds)
    shared = whole.sparkSession.sparkContext.broadcast(books)
    kinds = {f.name: f.dataType.simpleString() for f in whole.schema}
    coded = cut_lineage(
        whole.mapInArrow(lambda batches: _codes(batches, shared.value), f"id {kinds['id']}, label {kinds['label']}, length int, code string, error bigint")
    )
    totals = cut_lineage(
        coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("label_error"), F.count(F.lit(1)).alias("n"))
    )
    rows = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    digests = [F.lit(x) for length, own in sorted(books.items()) for x in (length, digest(own))]
    named = F.create_map(*digests)[F.col("length")] if digests else F.lit(None).cast("string")
    return look_up(coded, totals, ["label"], "n", rows).select(
        F.col("id").alias("vec_id"), "code", "error", F.col("label_error").try_cast("bigint").alias("label_error"), named.alias("codebooks_sha256")
    )
