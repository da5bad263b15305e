"""Whitened embeddings: the covariance's eigenvectors by rank-one updates, combined in a tree and refined once."""

from __future__ import annotations

import decimal
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from lexmill.llm.spectra import Spectrum, add_vector, combine, empty_spectrum
from lexmill.session import cut_lineage, spread

SCALE = 256
COMPONENTS = 4
# Different vectors that one task decomposes, and states that one task combines.
VECTORS_PER_TASK = 4_096
FAN_IN = 16
SMALL = float(1 << 62)


class Basis(NamedTuple):
    """What the fit list says of vectors of one length."""

    n: int
    sums: list[int]
    mean: np.ndarray
    axes: np.ndarray
    values: np.ndarray
    trace: float

    def directions(self) -> np.ndarray:
        """Axes divided by their standard deviation; NaN for axes without variance."""
        return self.axes / np.sqrt(np.where(self.has_variance(), self.values, np.nan))

    def has_variance(self) -> np.ndarray:
        return self.values > len(self.mean) * np.finfo(np.float64).eps * self.trace


def _whole(batch: pa.RecordBatch, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, floor(scale * vector) as 64-bit integers) for each length of vector; rows that are dropped are left out."""
    column = batch.column(batch.schema.names.index("vector"))
    there = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    lengths = column.value_lengths().take(pa.array(there)).to_numpy(zero_copy_only=False) if len(there) else there
    for length in np.unique(lengths).tolist():
        rows = there[lengths == length]
        flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore", invalid="ignore"):
            scaled = np.floor(flat.astype(np.float64).reshape(len(rows), int(length)) * scale)
            fits = (np.abs(scaled) < 2.0**63).all(axis=1)
        yield rows[fits], scaled[fits].astype(np.int64)


def _packed(matrix: np.ndarray) -> list[bytes]:
    """Each row's integers as bytes, as wide as its largest needs; equal rows have equal bytes."""
    most = np.maximum(matrix.max(axis=1, initial=0), -1 - matrix.min(axis=1, initial=0))
    out: list[bytes] = [b""] * len(matrix)
    width = np.select([most < 1 << 7, most < 1 << 15, most < 1 << 31], [1, 2, 4], 8)
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        data, step = matrix[rows].astype(f"<i{w}").tobytes(), w * matrix.shape[1]
        for k, r in enumerate(rows.tolist()):
            out[r] = bytes([w]) + data[k * step : (k + 1) * step]
    return out


def _unpacked(values: list[bytes]) -> np.ndarray:
    """The matrix of rows of one length."""
    return np.stack([np.frombuffer(v, dtype=f"<i{v[0]}", offset=1).astype(np.int64) for v in values])


def _prepared(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vector"))
    kind = rows.schema["vector"].dataType
    if not (isinstance(kind, ArrayType) and isinstance(kind.elementType, (FloatType, DoubleType))):
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    return spread(rows)


def fit_list(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(length, x): each different integer vector once, packed in bytes; repeats go before the shuffle."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, matrix in _whole(batch, scale):
                names = pa.array(np.full(len(matrix), matrix.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays([names, pa.array(_packed(matrix), pa.binary())], names=["length", "x"])

    rows = _prepared(vectors, id_col, vector_col).select("vector")
    return cut_lineage(rows.mapInArrow(pack, "length int, x binary").where("length > 0").distinct())


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    for batch in batches:
        length = batch.column(0).to_numpy()
        for size in np.unique(length).tolist():
            yield int(size), _unpacked(batch.column(1).take(pa.array(np.flatnonzero(length == size))).to_pylist())


def exact_sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """For each length (n, sum of every component), without rounding; each task sums its own vectors first."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        for length, matrix in _groups(batches):
            n, total = held.get(length, (0, np.zeros(length, dtype=object)))
            if float(np.abs(matrix).max()) * len(matrix) < SMALL:
                held[length] = n + len(matrix), total + matrix.sum(axis=0).astype(object)
            else:
                held[length] = n + len(matrix), total + matrix.astype(object).sum(axis=0)
        for length, (n, total) in held.items():
            cells = [decimal.Decimal(x) for x in total.tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(length, length, dtype=np.int32)),
                    pa.array(np.arange(length, dtype=np.int32)),
                    pa.array(np.full(length, n, dtype=np.int64)),
                    pa.array(cells, pa.decimal128(38, 0)),
                ],
                names=["length", "place", "n", "total"],
            )

    parts = fit.mapInArrow(add, "length int, place int, n bigint, total decimal(38,0)")
    rows = parts.groupBy("length", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("length", "place").collect()
    found: dict[int, tuple[int, list[int]]] = {}
    for r in rows:
        found.setdefault(r["length"], (r["n"], []))[1].append(int(r["total"]))
    return found


State = tuple[int, bytes]


def combined(states: DataFrame, merge: Callable[[int, list[State]], State]) -> dict[int, State]:
    """One state per length of `states` (length, n, state), combined FAN_IN at a time, level by level.

    No task ever holds more than FAN_IN states, nor does the driver get more than that of a length.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], State] = {}
        for batch in batches:
            for length, slot, n, state in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                key = (length, slot)
                held[key] = merge(length, [held[key], (n, state)]) if key in held else (n, state)
        for (length, slot), (n, state) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([length], pa.int32()), pa.array([slot], pa.int64()), pa.array([n], pa.int64()), pa.array([state], pa.binary())],
                names=["length", "slot", "n", "state"],
            )

    slots = cut_lineage(states.withColumn("slot", F.monotonically_increasing_id()).select("length", "slot", "n", "state"))
    counts = {r["length"]: r["c"] for r in slots.groupBy("length").agg(F.count(F.lit(1)).alias("c")).collect()}
    while any(c > FAN_IN for c in counts.values()):
        groups = -(-sum(counts.values()) // FAN_IN)
        dealt = slots.withColumn("slot", F.pmod(F.xxhash64("slot"), F.lit(groups))).repartition(groups, "length", "slot")
        slots = cut_lineage(dealt.mapInArrow(fold, "length int, slot bigint, n bigint, state binary").withColumn("slot", F.monotonically_increasing_id()))
        counts = {r["length"]: r["c"] for r in slots.groupBy("length").agg(F.count(F.lit(1)).alias("c")).collect()}
    last = slots.withColumn("slot", F.lit(0).cast("bigint")).repartition("length")
    return {r["length"]: (r["n"], bytes(r["state"])) for r in last.mapInArrow(fold, "length int, slot bigint, n bigint, state binary").collect()}


def _state_rows(held: dict[int, State]) -> Iterator[pa.RecordBatch]:
    for length, (n, state) in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([length], pa.int32()), pa.array([n], pa.int64()), pa.array([state], pa.binary())], names=["length", "n", "state"])


def spectra(fit: DataFrame, n: int) -> dict[int, Spectrum]:
    """The spectrum of every length: tasks of VECTORS_PER_TASK vectors update theirs, the tree combines them."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Spectrum] = {}
        for length, matrix in _groups(batches):
            now = held.get(length) or empty_spectrum(length)
            for vector in matrix.astype(np.float64):
                now = add_vector(now, vector)
            held[length] = now
        yield from _state_rows({k: (s.n, s.to_bytes()) for k, s in held.items()})

    def merge(length: int, states: list[State]) -> State:
        one, other = (Spectrum.from_bytes(n, length, data) for n, data in states)
        both = combine(one, other)
        return both.n, both.to_bytes()

    dealt = fit.repartition(max(1, -(-n // VECTORS_PER_TASK)))
    found = combined(dealt.mapInArrow(grow, "length int, n bigint, state binary"), merge)
    return {length: Spectrum.from_bytes(n, length, data) for length, (n, data) in found.items()}


def _products(fit: DataFrame, turns: dict[int, tuple[np.ndarray, np.ndarray]]) -> dict[int, np.ndarray]:
    """For each length the sum of y y^T over the fit list, where y = turn^T (x - mean)."""
    shared = fit.sparkSession.sparkContext.broadcast(turns)

    def square(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        for length, matrix in _groups(batches):
            mean, turn = shared.value[length]
            turned = (matrix - mean) @ turn
            n, total = held.get(length, (0, 0.0))
            held[length] = n + len(matrix), total + turned.T @ turned
        yield from _state_rows({k: (n, total.tobytes()) for k, (n, total) in held.items()})

    def merge(_: int, states: list[State]) -> State:
        (n, one), (m, other) = states
        return n + m, (np.frombuffer(one) + np.frombuffer(other)).tobytes()

    found = combined(fit.mapInArrow(square, "length int, n bigint, state binary"), merge)
    return {k: np.frombuffer(data).reshape(turns[k][1].shape[1], -1) for k, (_, data) in found.items()}


def fit_bases(fit: DataFrame, components: int = COMPONENTS) -> dict[int, Basis]:
    """The leading axes of every length's covariance, by falling eigenvalue.

    The combined spectrum gives an orthonormal basis that is exact but for the rounding of many
    updates. Rayleigh-Ritz over the whole fit list, with exact means, takes that rounding out:
    the basis is orthonormalised, the covariance projected on it in one distributed pass, and the
    small nearly diagonal projection decomposed. The largest entry of an axis is positive.
    """
    sums = exact_sums(fit)
    means = {length: np.array([s / n for s in total]) for length, (n, total) in sums.items()}
    rough = spectra(fit, sum(n for n, _ in sums.values()))
    turns = {length: (means[length], np.linalg.qr(s.vectors[:, ::-1])[0]) for length, s in rough.items()}
    bases = {}
    for length, product in _products(fit, turns).items():
        n, total = sums[length]
        values, mixes = np.linalg.eigh(product / n)
        axes = turns[length][1] @ mixes[:, ::-1][:, :components]
        axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
        bases[length] = Basis(n, total, means[length], axes, np.maximum(values[::-1][:components], 0.0), float(np.trace(product / n)))
    return bases


def identity_errors(fit: DataFrame, bases: dict[int, Basis]) -> dict[int, float]:
    """How far the whitened fit list's covariance is from the identity, over the axes that have variance."""
    turns = {k: (b.mean, b.directions()[:, b.has_variance()]) for k, b in bases.items() if b.has_variance().any()}
    found = _products(fit, turns) if turns and len(turns) == len(bases) else {}
    if turns and len(turns) < len(bases):
        found = _products(fit.where(F.col("length").isin(sorted(turns))), turns)
    return {k: float(np.abs(found[k] / b.n - np.eye(len(found[k]))).max()) if k in found else 0.0 for k, b in bases.items()}


def _deviations(matrix: np.ndarray, n: int, sums: list[int]) -> list[decimal.Decimal | None]:
    """Sum of (n * x - sum)^2 of every row, exactly; None beyond 38 digits."""
    length = matrix.shape[1]
    most = n * (int(np.abs(matrix).max(initial=0)) + 1) + max((abs(s) for s in sums), default=0)
    if most * most * max(length, 1) < 1 << 62:
        apart = n * matrix - np.array(sums, dtype=np.int64)
        exact = (apart * apart).sum(axis=1).tolist()
    else:
        total, squares = np.array(sums, dtype=object), sum(s * s for s in sums)
        wide = matrix.astype(object)
        exact = [n * n * int(a) - 2 * n * int(b) + squares for a, b in zip((wide * wide).sum(axis=1), wide @ total, strict=True)]
    return [decimal.Decimal(x) if x < 10**38 else None for x in exact]


def whiten_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, components: int = COMPONENTS
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per vector and component.

    Components of vectors become integers, floor(scale * c). The fit list holds each different
    integer vector once; n and the sums behind `deviation`, a decimal of 38 digits (NULL beyond),
    are exact. `whitened` is the projection on the component over its standard deviation,
    `explained` the component's share of the whole variance, `identity_error` the largest entry
    of the whitened fit list's covariance minus the identity.

    Vectors that are NULL, or hold NULL or non-finite components, or some whose integer does not
    fit 64 bits, are dropped. Vectors of each length have their own fit list and components; shorter ones
    than `components` have as many as their length. A component without variance has a NULL
    `whitened`, and a NULL `explained` if there is no variance at all; `identity_error` is over
    the others, 0 without any. Equal eigenvalues leave their axes free within their plane.
    Repeated ids and NULL ids are rows of their own. An empty table gives none. Other columns
    are not looked at.
    """
    fit = fit_list(vectors, id_col, vector_col, scale)
    bases = fit_bases(fit, components)
    errors = identity_errors(fit, bases)
    rows = _prepared(vectors, id_col, vector_col)
    shared = fit.sparkSession.sparkContext.broadcast((bases, errors))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, error_of = shared.value
        for batch in batches:
            for at, matrix in _whole(batch, scale):
                length = matrix.shape[1]
                if length not in known or not len(at):
                    continue
                basis = known[length]
                count = basis.axes.shape[1]
                white = (matrix - basis.mean) @ basis.directions()
                share = basis.values / basis.trace if basis.trace > 0 else np.full(count, np.nan)
                deviation = pa.array(_deviations(matrix, basis.n, basis.sums), pa.decimal128(38, 0))
                each = np.repeat(np.arange(len(at)), count)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at[each])),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(at))),
                        pa.array(np.full(len(each), basis.n, dtype=np.int64)),
                        deviation.take(pa.array(each)),
                        pa.array(white.ravel(), from_pandas=True),
                        pa.array(np.tile(share, len(at)), from_pandas=True),
                        pa.array(np.full(len(each), error_of[length])),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        project, f"vec_id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    )
