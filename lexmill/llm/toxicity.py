"""Toxic passages: maximal-scoring segments over token log-odds, judged by extreme-value statistics."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.quality import labelled_sample
from lexmill.llm.textkit import batches_of, distinct_sorted, releasing, slices, words_of
from lexmill.session import cut_lineage

# The model is fitted on at most this many labelled rows of each label and keeps at most this
# many terms, the surest ones, so what is broadcast has a fixed size.
MAX_LABELLED = 10_000
MAX_TERMS = 20_000
# Weight of the Dirichlet prior in documents, least certainty of a term's log-odds, the fewest
# toxic documents and the least share of them that must hold it, the least weight left of it.
PRIOR_WEIGHT = 20.0
MIN_Z = 4.0
MIN_DOCUMENTS = 4
MIN_SHARE = 0.01
MIN_WEIGHT = 1.5
# Beginnings of words stand for words that cannot be judged by themselves.
STEMS = (3, 4, 5, 6)
# What a word without a term costs a segment that runs over it, at least.
LEAST_DRIFT = 0.02
# A segment counts if a clean text of that length would hold a better one this rarely.
SIGNIFICANT = 0.02

_EDGES = ".,;:!?\"'()[]{}<>|*#$%&-_=+/\\~`…«»“”‘’"
_KEPT_WORDS = 100_000
TEXT_ROWS = 2_000


class Model(NamedTuple):
    weights: dict[str, float]
    drift: float
    rate: float
    factor: float
    prior: float


class Segment(NamedTuple):
    start: int
    end: int
    score: float
    chance: float


def bare(word: str) -> str:
    return word.lower().strip(_EDGES)


def stems_of(word: str) -> list[str]:
    """The beginnings of a bare word; the mark keeps them apart from words."""
    return [word[:n] + "-" for n in STEMS if len(word) >= n]


def word_weight(word: str, weights: dict[str, float]) -> float:
    """A word's own log-odds if it has any, else those of its strongest beginning, else 0."""
    word = bare(word)
    own = weights.get(word)
    if own is not None:
        return own
    return max((weights.get(t, 0.0) for t in stems_of(word)), default=0.0)


def maximal_segments(places: list[int], gains: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first word, last word, score) in linear time.

    `places` are the positions of the words with a positive score; each other word costs
    `drift`. Every candidate remembers the total before and after it; a new one is merged with
    the last earlier candidate that starts lower, unless that one ended as high.
    """
    kept: list[list[float]] = []
    total, at = 0.0, 0
    for place, gain in zip(places, gains, strict=True):
        total -= drift * (place - at)
        at = place + 1
        new = [place, place, total, total + gain]
        total += gain
        low = _last_lower(kept, new[2])
        while low is not None and kept[low][3] < new[3]:
            new[0], new[2] = kept[low][0], kept[low][2]
            del kept[low:]
            low = _last_lower(kept, new[2])
        new.append(-1 if low is None else low)
        kept.append(new)
    return [(int(c[0]), int(c[1]), c[3] - c[2]) for c in kept]


def _last_lower(kept: list[list[float]], level: float) -> int | None:
    """The last candidate whose total before it is lower; links skip those already seen to be higher."""
    at = len(kept) - 1
    while at >= 0 and kept[at][2] >= level:
        at = int(kept[at][4])
    return at if at >= 0 else None


def significant_segments(words: list[str], model: Model, memo: dict[str, float] | None = None) -> list[Segment]:
    """The segments that a clean text of this length would hold with a chance below SIGNIFICANT.

    The chance of a segment of at least that score is 1 - exp(-K n exp(-lambda S)).
    """
    memo = {} if memo is None else memo
    places, gains = [], []
    for i, word in enumerate(words):
        gain = memo.get(word)
        if gain is None:
            if len(memo) >= _KEPT_WORDS:
                memo.clear()
            memo[word] = gain = word_weight(word, model.weights)
        if gain > 0:
            places.append(i)
            gains.append(gain)
    found = []
    for start, end, score in maximal_segments(places, gains, model.drift):
        expected = model.factor * len(words) * math.exp(-model.rate * score)
        chance = -math.expm1(-expected)
        if chance < SIGNIFICANT:
            found.append(Segment(start, end + 1, score, chance))
    return found


def probability(segments: list[Segment], model: Model) -> float:
    """The chance that a text is toxic, from its prior and what its segments say together.

    Under the clean model their chances multiply; a toxic text is taken to hold them anyway.
    """
    clean = math.exp(sum(math.log(max(s.chance, 1e-300)) for s in segments))
    return model.prior / (model.prior + (1.0 - model.prior) * clean)


def _counts(sample: DataFrame, skip: frozenset[str] | None) -> DataFrame:
    """(term, toxic, clean): how many sampled documents of each label hold a term.

    Terms are words; with `skip`, the beginnings of all words not in it.
    """
    shared = sample.sparkSession.sparkContext.broadcast(skip)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            toxic, clean = Counter(), Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held = {bare(w) for w in set((text or "").split())}
                if known is not None:
                    held = {t for w in held - known for t in stems_of(w)}
                (toxic if label == 1 else clean).update(held - {""})
            names = sorted(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([toxic[t] for t in names], pa.int64()), pa.array([clean[t] for t in names], pa.int64())],
                names=["term", "toxic", "clean"],
            )

    counted = sample.select("text", "label").mapInArrow(releasing(count), "term string, toxic bigint, clean bigint")
    return counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _log_odds(counts: DataFrame, toxic_docs: int, clean_docs: int) -> DataFrame:
    """`counts` with a `weight` that is NULL for terms that are not surely more frequent in toxic texts."""
    mass = F.lit(PRIOR_WEIGHT) * (F.col("toxic") + F.col("clean")) / F.lit(float(toxic_docs + clean_docs))
    in_toxic, in_clean = F.col("toxic") + mass, F.col("clean") + mass
    odds = lambda held, total: F.log(held / (F.lit(total + PRIOR_WEIGHT) - held + 1.0))
    spread = F.sqrt(1.0 / in_toxic + 1.0 / in_clean)
    apart = odds(in_toxic, toxic_docs) - odds(in_clean, clean_docs)
    least = max(MIN_DOCUMENTS, math.ceil(MIN_SHARE * toxic_docs))
    sure = (F.col("toxic") >= least) & (apart / spread >= MIN_Z) & (apart - spread >= MIN_WEIGHT)
    return counts.select(
        "*",
        (apart / spread).alias("z"),
        F.when(sure, F.round(apart - spread, 2)).alias("weight"),
        (apart + spread < MIN_WEIGHT).alias("plain"),
    )


def _weights(sample: DataFrame, toxic_docs: int, clean_docs: int) -> dict[str, float]:
    """Weights of words, then of the beginnings of words too rare to have one of their own.

    A word that surely has no such weight is kept with 0 if it begins like a toxic one. The sample is
    bounded, and so are these lists: each holds at most MAX_TERMS terms.
    """
    words = cut_lineage(
        _log_odds(_counts(sample, None), toxic_docs, clean_docs).where(
            F.col("weight").isNotNull() | F.col("plain")
        )
    )

    def strongest(terms: DataFrame) -> dict[str, float]:
        rows = terms.where("weight IS NOT NULL").orderBy(F.col("z").desc(), "term").limit(MAX_TERMS)
        return {r["term"]: float(r["weight"]) for r in rows.select("term", "weight").collect()}

    found = strongest(words)
    frequent = words.where("plain").orderBy((F.col("toxic") + F.col("clean")).desc(), "term").limit(MAX_TERMS).select("term")
    known = frozenset(r["term"] for r in frequent.collect()) | found.keys()
    stems = strongest(_log_odds(_counts(sample, frozenset(known)), toxic_docs, clean_docs))
    plain = {w: 0.0 for w in known if w not in found and any(t in stems for t in stems_of(w))}
    return plain | stems | found


def _one_of_each_kind(sample: DataFrame) -> DataFrame:
    """One sampled text of those that share their smallest hash of five words, near copies mostly."""

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                doc, hashes = distinct_sorted(*words_of(part).shingles(5))
                first = dict(zip(doc[::-1].tolist(), hashes[::-1].astype("int64").tolist(), strict=True))
                kind = pa.array([first.get(i) for i in range(part.num_rows)], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, kind], names=[*part.schema.names, "kind"])

    marked = sample.select("text", "label", "_id").mapInArrow(
        releasing(smallest), f"text string, label {sample.schema['label'].dataType.simpleString()}, _id {sample.schema['_id'].dataType.simpleString()}, kind bigint"
    )
    return marked.groupBy("kind", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def _clean_statistics(sample: DataFrame, weights: dict[str, float]) -> tuple[Counter, int]:
    """How often each positive weight occurs among the words of the clean texts, and their number.

    One row per weight and partition is shuffled; at most MAX_TERMS rows reach the driver.
    """
    shared = sample.sparkSession.sparkContext.broadcast(weights)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        memo: dict[str, float] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for word, n in Counter((text or "").split()).items():
                    gain = memo.get(word)
                    if gain is None:
                        memo[word] = gain = word_weight(word, shared.value)
                    seen[gain] += n
                if len(memo) >= _KEPT_WORDS:
                    memo.clear()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen.keys()), pa.float64()), pa.array(list(seen.values()), pa.int64())], names=["weight", "n"]
        )

    counted = sample.where(F.col("label") == 0).select("text").mapInArrow(releasing(tally), "weight double, n bigint")
    rows = counted.groupBy("weight").agg(F.sum("n").alias("n")).collect()
    return Counter({r["weight"]: r["n"] for r in rows if r["weight"] > 0}), sum(r["n"] for r in rows)


def _rate(shares: dict[float, float], drift: float) -> float:
    """The positive lambda at which the mean of exp(lambda * score) of a clean word is 1."""
    rest = 1.0 - sum(shares.values())

    def mean(rate: float) -> float:
        return rest * math.exp(-rate * drift) + sum(p * math.exp(min(rate * s, 700.0)) for s, p in shares.items())

    low, high = 0.0, 1e-3
    while mean(high) < 1.0 and high < 1e3:
        low, high = high, high * 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1.0 else (low, middle)
    return high


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic",
    folds: int = 3, held_out: int = 1, limit: int = MAX_LABELLED,
) -> Model:
    """Fit the term weights and the extreme-value parameters on a bounded labelled sample.

    A term's log-odds compare the documents of each label that hold it, with a Dirichlet prior
    in proportion to the term's share of all; its weight is the lower end of what its variance
    allows. Near copies among the labelled texts count once. Without labelled rows of both
    labels there are no terms and every score is the prior.
    """
    # A task counts the terms of so many texts at a time.
    with batches_of(docs.sparkSession, TEXT_ROWS):
        return _fit(labelled_sample(docs, labels, label, folds, held_out, limit, id_col, text_col))


def _fit(sample: DataFrame) -> Model:
    kinds = cut_lineage(_one_of_each_kind(sample))
    n = {r["label"]: r["n"] for r in kinds.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic_docs, clean_docs = n.get(1, 0), n.get(0, 0)
    prior = (toxic_docs + 1.0) / (toxic_docs + clean_docs + 2.0) if n else 0.1
    prior = min(prior, 0.2)
    if not toxic_docs or not clean_docs:
        return Model({}, LEAST_DRIFT, 1.0, 1.0, prior)
    weights = _weights(kinds, toxic_docs, clean_docs)
    if not any(weights.values()):
        return Model({}, LEAST_DRIFT, 1.0, 1.0, prior)
    seen, words = _clean_statistics(kinds, weights)
    seen[max(weights.values())] += 0.5  # an event not yet seen among the clean words
    shares = {s: k / (words + 1.0) for s, k in seen.items()}
    gain = sum(s * p for s, p in shares.items())
    drift = max(LEAST_DRIFT, 2.0 * gain)  # the mean score of a clean word must be negative
    rate = _rate(shares, drift)
    # K from the clean words themselves: so many of n words begin a segment of the least weight.
    factor = sum(shares.values()) * math.exp(rate * min(shares))
    return Model(weights, drift, rate, factor, prior)


def find_toxic(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, segments, score) of every whole text.

    `segments` holds every significant passage: first word and the word behind its last, score
    and chance. `score` runs from the prior of a text without passages (NULL and empty texts
    too) to 1. Rows are judged one by one with a broadcast model of bounded size: no shuffle.
    Repeated rows repeat their result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
    kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("chance", pa.float64())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, memo = Model(*shared.value), {}
        for batch in batches:
            for part in slices(batch):
                found = [significant_segments((t or "").split(), own, memo) for t in part.column(1).to_pylist()]
                passages = pa.array([[s._asdict() for s in row] for row in found], pa.list_(kind))
                scores = pa.array([probability(row, own) for row in found], pa.float64())
                yield pa.RecordBatch.from_arrays([part.column(0), passages, scores], names=["doc_id", "segments", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        releasing(judge),
        f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
        "segments array<struct<start:int,end:int,score:double,chance:double>>, score double",
    )


def without_toxic(docs: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose score is below `least`, with all their columns; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, memo = Model(*shared.value), {}
        for batch in batches:
            for part in slices(batch, text_col):
                texts = part.column(part.schema.names.index(text_col)).to_pylist()
                clean = [probability(significant_segments((t or "").split(), own, memo), own) < least for t in texts]
                yield part.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(releasing(keep), docs.schema)
