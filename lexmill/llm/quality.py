"""Quality by nearest neighbours: labelled latent-semantic vectors vote, weighted by cosine."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.textkit import releasing
from lexmill.session import cut_lineage

# The model: at most this many labelled rows of each label, hashed terms, latent dimensions,
# neighbours that vote. Its size is therefore fixed: below 4 MB, whatever the input.
MAX_LABELLED = 2_500
TERMS = 1_024
DIMENSIONS = 64
NEIGHBOURS = 25
# Documents whose products with all labelled vectors are computed at a time.
BLOCK = 512

# Letters to a, capitals to A, digits to 9; blanks and signs stay. Bytes of other scripts count as letters.
_SHAPE = bytearray(range(256))
for _b in range(256):
    if 0x30 <= _b <= 0x39:
        _SHAPE[_b] = 0x39
    elif 0x41 <= _b <= 0x5A:
        _SHAPE[_b] = 0x41
    elif 0x61 <= _b <= 0x7A or _b >= 0x80:
        _SHAPE[_b] = 0x61
_SHAPE = bytes(_SHAPE)
_RUN = re.compile(rb"(.)\1+", re.S)
_LETTERS = re.compile(rb"[aA9]+")


class Model(NamedTuple):
    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    prior: float


def _slot(term: bytes) -> int:
    return zlib.crc32(term) % TERMS


_slots: dict[bytes, tuple[int, ...]] = {}


def _forget_slots() -> None:
    _slots.clear()


def _shape_slots(shape: bytes) -> tuple[int, ...]:
    """Slots of one word's shape: the run-length form, its signs alone, its length class."""
    got = _slots.get(shape)
    if got is None:
        form = _RUN.sub(rb"\1", shape)
        signs = _LETTERS.sub(b"", shape)
        terms = [b"f" + form[:12], b"n%d" % min(len(shape), 24)]
        if signs:
            terms.append(b"s" + signs[:6])
            terms.extend(b"c%d" % c for c in set(signs))
        got = tuple(_slot(t) for t in terms)
        if len(_slots) >= 50_000:
            _slots.clear()
        _slots[shape] = got
    return got


def term_counts(text: bytes) -> dict[int, float]:
    """Hashed terms of a whole text and how often each occurs.

    Terms are shapes of words (case, digits, signs around them), classes of repetition (lines
    and words seen before) and of length. No word itself is a term.
    """
    words = text.split()
    found: dict[int, float] = {}
    for shape, n in Counter(text.translate(_SHAPE).split()).items():
        for s in _shape_slots(shape):
            found[s] = found.get(s, 0.0) + n
    lines = [line for line in text.split(b"\n") if line.strip()]
    again = len(lines) - len(set(lines))
    fresh = len(set(words))
    scale = float(max(len(words), 1))
    for name, share in (
        (b"line again", again / max(len(lines), 1)),
        (b"word again", 1.0 - fresh / scale if words else 0.0),
        (b"no words", 0.0 if words else 1.0),
    ):
        if share:
            # As heavy as if that share of the words were this term.
            found[_slot(b"r" + name + b"%d" % int(share * 8))] = scale * share
    found[_slot(b"l%d" % int(math.log2(scale)))] = scale / 4
    return found


def damped(counts: list[dict[int, float]]) -> np.ndarray:
    """One row of damped, unit-length term weights for each text's counts."""
    rows = np.zeros((len(counts), TERMS), dtype=np.float32)
    for i, found in enumerate(counts):
        at = np.fromiter(found, dtype=np.int64, count=len(found))
        n = np.fromiter(found.values(), dtype=np.float64, count=len(found))
        rows[i, at] = np.sqrt(n / max(n.sum(), 1.0))
    return rows


def term_matrix(texts: list[bytes]) -> np.ndarray:
    return damped([term_counts(text) for text in texts])


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size > 0, size, 1.0)


def fit(rows: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS, neighbours: int = NEIGHBOURS) -> Model:
    """Latent vectors of labelled rows of term weights by a truncated singular value decomposition."""
    prior = float((labels.sum() + 1) / (len(labels) + 2))
    if not len(rows):
        nothing = np.zeros((0, 1), dtype=np.float32)
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), nothing, labels.astype(np.float32), 0, prior)
    idf = np.log((1 + len(rows)) / (1 + (rows > 0).sum(axis=0))).astype(np.float32) + 1
    weighed = _unit(rows * idf)
    # The Gram matrix of the terms has a fixed size; its first eigenvectors are the latent axes.
    values, vectors = np.linalg.eigh((weighed.T @ weighed).astype(np.float64))
    axes = np.ascontiguousarray(vectors[:, ::-1][:, :dimensions]).astype(np.float32)
    axes *= np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    return Model(idf, axes, _unit(weighed @ axes).astype(np.float32), labels.astype(np.float32), min(neighbours, len(rows)), prior)


def vote(model: Model, texts: list[bytes]) -> np.ndarray:
    """Share of label 1 among the nearest labelled vectors, each weighted by its cosine, 0 to 1."""
    if not model.neighbours:
        return np.full(len(texts), model.prior)
    scores = np.empty(len(texts))
    for at in range(0, len(texts), BLOCK):
        latent = _unit(_unit(term_matrix(texts[at : at + BLOCK]) * model.idf) @ model.axes)
        cosines = latent @ model.vectors.T
        k = model.neighbours
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(cosines, near, axis=1), 0.0, None).astype(np.float64) ** 8
        ones = (weight * model.labels[near]).sum(axis=1) + model.prior * 1e-6
        scores[at : at + BLOCK] = ones / (weight.sum(axis=1) + 1e-6)
    return np.clip(scores, 0.0, 1.0)


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, limit: int, id_col: str, text_col: str
) -> DataFrame:
    """(text, label) of at most about `limit` rows of each label, none of them held out.

    Rows are taken by a hash of their id, so a rerun takes the same ones; each text is taken
    once. Labels other than 0 and 1 are ignored; of contradicting labels of an id the smaller holds.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & (fold(F.col(id_col), folds) != held_out))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.min(label).alias("_label"))
    )
    totals = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Twice the limit may pass the hash; what is above it is cut off after texts are made distinct.
    share = F.lit(0.0)
    for value, n in totals.items():
        share = F.when(F.col("_label") == value, F.lit(min(1.0, 1.25 * limit / n))).otherwise(share)
    place = F.pmod(F.xxhash64("_id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    picked = known.where(place < share)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    taken = rows.join(F.broadcast(picked), "_id").groupBy("text").agg(F.min("_label").alias("label"), F.min("_id").alias("_id"))
    return cut_lineage(taken.where(F.col("text").isNotNull()))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality",
    folds: int = 5, held_out: int = 0, limit: int = MAX_LABELLED, neighbours: int = NEIGHBOURS,
) -> Model:
    """Fit on a bounded sample: the terms of at most `limit` rows of each label reach the driver.

    Texts stay on the executors; a row's terms are fewer than TERMS, however long its text.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [term_counts((t or "").encode()) for t in batch.column(0).to_pylist()]
            terms = pa.array([list(f) for f in found], pa.list_(pa.int32()))
            counts = pa.array([list(f.values()) for f in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], terms, counts], names=["label", "place", "terms", "counts"])

    sample = labelled_sample(docs, labels, label, folds, held_out, limit, id_col, text_col)
    counted = sample.select("text", "label", F.xxhash64("_id", "text").alias("place")).mapInArrow(
        releasing(count, _forget_slots), f"label {sample.schema['label'].dataType.simpleString()}, place bigint, terms array<int>, counts array<double>"
    )
    found, values = [], []
    for value in (0, 1):
        for row in counted.where(F.col("label") == value).orderBy("place").limit(limit).collect():
            found.append(dict(zip(row["terms"], row["counts"], strict=True)))
            values.append(value)
    return fit(damped(found), np.array(values, dtype=np.float32), neighbours=neighbours)


def score_quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score): the vote for every whole text, from 0 to 1.

    The model is broadcast; every document's products with all labelled vectors are computed in
    blocks, and nothing is shuffled. NULL counts as the empty text, which has a vector of its
    own; without labelled rows every score is the prior. Repeated rows repeat their score.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                texts = [(t or "").encode() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(vote(own, texts))], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(releasing(score, _forget_slots), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def good_documents(docs: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose score is at least `least`, with all their columns; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                texts = [(t or "").encode() for t in part.column(part.schema.names.index(text_col)).to_pylist()]
                yield part.filter(pa.array(vote(own, texts) >= least))

    return docs.mapInArrow(releasing(keep, _forget_slots), docs.schema)
