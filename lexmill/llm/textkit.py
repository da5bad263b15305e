"""Whole texts as bytes: word boundaries and 64-bit hashes for many documents at a time.

The functions work on one Arrow string column at a time, in slices of bounded size, so that
a task's memory does not depend on its number of rows. Only the longest single text must fit.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

# Slices hold at most so many bytes of text, or one text.
SLICE_BYTES = 1 << 20

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BYTE_VALUES = np.random.default_rng(0x5EED).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C55)
_powers = np.ones(1, dtype=np.uint64)
# Powers for words up to this length stay in the worker; longer words get theirs anew.
KEEP_POWERS = 1 << 16


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows while the block runs its own jobs; rows may be large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def nothing_kept(*forget: Callable[[], None]) -> Iterator[None]:
    """For the work of one task: its worker lives on, but caches and freed memory do not stay with it."""
    try:
        yield
    finally:
        for empty in forget:
            empty()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def releasing(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], *forget: Callable[[], None]):
    """`work` over a task's batches, after which nothing is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with nothing_kept(*forget):
            yield from work(batches)

    return run


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> np.ndarray:
    """The first n powers of the hash's multiplier, modulo 2^64."""
    global _powers
    if len(_powers) >= n:
        return _powers[:n]
    grown = np.full(max(n, 1024), _STEP, dtype=np.uint64)
    grown[0] = 1
    grown = np.multiply.accumulate(grown)
    if len(grown) <= KEEP_POWERS:
        _powers = grown
    return grown[:n]


class Words:
    """The words of some texts: `hashes` in text order, `doc` the row each one stands in.

    A word is a maximal run of bytes that are not blank (space, tab, line ends), with A-Z
    lower-cased. Two different words share a hash with a chance of about 2^-64.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.n_docs = len(offsets) - 1
        self.data = _LOWER[data]
        word = ~_BLANK[data]
        cuts = offsets[:-1][offsets[:-1] < offsets[1:]]
        before = np.empty_like(word)
        before[:1] = False
        before[1:] = word[:-1]
        before[cuts] = False
        self.starts = np.flatnonzero(word & ~before)
        after = np.empty_like(word)
        after[-1:] = False
        after[:-1] = word[1:]
        after[cuts[cuts > 0] - 1] = False
        self.ends = np.flatnonzero(word & ~after) + 1
        self.doc = np.searchsorted(offsets, self.starts, side="right") - 1
        self.counts = np.bincount(self.doc, minlength=self.n_docs).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.hashes = self._hash(word)

    def _hash(self, word: np.ndarray) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        lengths = self.ends - self.starts
        heads = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(heads, lengths)
        values = _BYTE_VALUES[self.data[word]] * powers(int(lengths.max()))[place]
        return mix64(np.add.reduceat(values, heads) + lengths.astype(np.uint64))

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash) of every run of `width` words; a shorter text is one shingle, an empty one none."""
        n = len(self.hashes)
        usable = self.counts >= width
        short = np.flatnonzero((self.counts > 0) & ~usable)
        hashes, doc = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        if n >= width:
            run = self.hashes[: n - width + 1].copy()
            for k in range(1, width):
                run = run * _STEP + self.hashes[k : n - width + 1 + k]
            inside = self.doc[: n - width + 1] == self.doc[width - 1 :]
            hashes, doc = mix64(run[inside]), self.doc[: n - width + 1][inside]
        if len(short):
            extra = np.zeros(len(short), dtype=np.uint64)
            for at, d in enumerate(short):
                run = int(self.counts[d])
                for h in self.hashes[self.first[d] : self.first[d + 1]].tolist():
                    run = (run * int(_STEP) + h) & 0xFFFFFFFFFFFFFFFF
                extra[at] = run
            hashes = np.concatenate([hashes, mix64(mix64(extra))])
            doc = np.concatenate([doc, short])
            order = np.argsort(doc, kind="stable")
            hashes, doc = hashes[order], doc[order]
        return doc, hashes


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL is the empty text."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(at):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    body = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if at[-1] > at[0] else np.zeros(0, dtype=np.uint8)
    return body, at - at[0]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most `limit` bytes of text, or of one row."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(batch.schema.names.index(text)))
    row = 0
    while row < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        stop = min(max(stop, row + 1), batch.num_rows)
        yield batch.slice(row, stop - row)
        row = stop


def words_of(batch: pa.RecordBatch, text: str = "text") -> Words:
    return Words(*text_bytes(batch.column(batch.schema.names.index(text))))


def distinct_sorted(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs without repeats, sorted by row and hash."""
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    if not len(doc):
        return doc, hashes
    fresh = np.ones(len(doc), dtype=bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return doc[fresh], hashes[fresh]
