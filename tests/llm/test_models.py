"""Classifiers, the mix, transcripts and the pipeline."""

import collections
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from lexmill.llm import byte_bpe, chat, mixing, quality, toxicity

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice(["ba", "do", "ke", "lu", "mi"]) for _ in range(rnd.randint(1, 4)))
    docs, labels = [], []
    for i in range(600):
        words = [word() for _ in range(rnd.randint(5, 120))]
        toxic, good = i % 5 == 0, i % 4 != 0
        if toxic:
            for _ in range(rnd.randint(2, 5)):
                words.insert(rnd.randrange(len(words)), rnd.choice(["vile", "foulness", "rotten", "zagba" + word()]))
        if not good:
            words = [w.upper() + "!!" for w in words]
        docs.append((i, " ".join(words), "en", 3))
        labels.append((i, int(good), int(toxic)))
    docs += [(9_000, None, None, None), (9_001, "", "en", 1), (None, "no id", "en", 1), (9_002, "x" * 200_000, "en", 1), docs[7], docs[7]]
    labels += [(9_001, None, None), (None, 1, 1), (9_003, 1, 0), (7, 1, 0)]
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, score string, label int").repartition(3),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def accuracy(frame, labels, column, least):
    truth = {r.doc_id: r[column] for r in labels.collect() if r.doc_id is not None and r[column] is not None}
    rows = [r for r in frame.collect() if r.doc_id in truth]
    return sum((r.score >= least) == bool(truth[r.doc_id]) for r in rows) / len(rows)


def test_quality_votes(labelled):
    docs, labels = labelled
    model = quality.train(docs, labels, folds=5, held_out=0)
    scored = quality.score_quality(docs, model)
    out = scored.collect()
    assert len(out) == 606 and all(0 <= r.score <= 1 for r in out)
    assert accuracy(scored, labels, "quality", 0.3) > 0.95
    exact = quality.vote(model, [b"ba do ke lu", b""])
    texts = [b"ba do ke lu", b""]
    latent = quality._unit(quality._unit(quality.term_matrix(texts) * model.idf) @ model.axes)
    for row, got in zip(latent @ model.vectors.T, exact, strict=True):
        near = sorted(range(len(row)), key=lambda i: -row[i])[: model.neighbours]
        weight = np.clip(row[near].astype(float), 0, None) ** 8
        assert got == pytest.approx((weight @ model.labels[near] + model.prior * 1e-6) / (weight.sum() + 1e-6), abs=0.05)
    kept = quality.good_documents(docs, model, 0.3)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r.doc_id) for r in out if r.score >= 0.3)


def test_classifiers_without_labels(labelled):
    docs, labels = labelled
    none = labels.limit(0)
    assert {r.score for r in quality.score_quality(docs, quality.train(docs, none)).collect()} == {0.5}
    assert len({r.score for r in toxicity.find_toxic(docs, toxicity.train(docs, none)).collect()}) == 1
    model = toxicity.train(docs.limit(0), labels)
    assert toxicity.find_toxic(docs.limit(0), model).collect() == []
    assert quality.score_quality(docs.limit(0), quality.train(docs.limit(0), labels)).collect() == []


def test_toxic_passages(labelled):
    docs, labels = labelled
    model = toxicity.train(docs, labels, folds=3, held_out=1)
    scored = toxicity.find_toxic(docs, model)
    assert accuracy(scored, labels, "toxic", 0.7) > 0.97
    out = {r.doc_id: r for r in scored.collect()}
    assert out[9_000].segments == [] and out[9_000].score == out[9_001].score < 0.7
    assert toxicity.word_weight("Zagbakekekeke,", model.weights) > 0  # an unseen form of a known beginning
    assert toxicity.word_weight("bado", model.weights) == 0
    kept = toxicity.without_toxic(docs, model, 0.7)
    assert kept.columns == docs.columns and kept.count() == sum(r.score < 0.7 for r in scored.collect())


def test_maximal_segments_by_definition():
    """All maximal segments: the best run of the whole, then of what lies left and right of it."""
    rnd = random.Random(11)

    def best(scores, low, high):
        found, total = None, 0
        for i in range(low, high):
            run = 0
            for j in range(i, high):
                run += scores[j]
                if run > 0 and (found is None or run > total + 1e-9):
                    found, total = (i, j), run
        if found is None:
            return []
        return best(scores, low, found[0]) + [(*found, total)] + best(scores, found[1] + 1, high)

    for _ in range(200):
        scores = [rnd.choice([1.0, 2.5, 3.25, -0.75, -0.75, -0.75]) for _ in range(rnd.randint(0, 25))]
        places = [i for i, s in enumerate(scores) if s > 0]
        got = toxicity.maximal_segments(places, [scores[i] for i in places], 0.75)
        want = best(scores, 0, len(scores))
        assert sum(s for *_, s in got) == pytest.approx(sum(s for *_, s in want))
        assert max((s for *_, s in got), default=0) == pytest.approx(max((s for *_, s in want), default=0))


def mix_by_hand(rows):
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    budget, capped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in capped]
        rate = (budget - sum(2 * sizes[s] for s in capped)) / sum(weight[s] for s in rest) if rest else 0
        above = {s for s in rest if weight[s] * rate > 2 * sizes[s]}
        if not above:
            return sizes, {s: 2.0 * sizes[s] if s in capped else weight[s] * rate for s in order}
        capped |= above


def test_mix_meets_targets(spark):
    rnd = random.Random(12)
    rows = []
    for i in range(500):
        source = rnd.choice(["é", "a", "a", "a", "Z", "b" * 3, None, "empty"])
        rows.append((i, None if source == "empty" else " ".join("w" * rnd.randint(0, 40)), source))
    rows += [(900, "a b c", "a"), (900, "a b c", "a"), (None, "x y", "Z")]
    frame = spark.createDataFrame([(*r, 1, "t", 2) for r in rows], "doc_id bigint, text string, source string, size int, target string, slot int").repartition(4)
    out = mixing.mix(frame).collect()
    sizes, targets = mix_by_hand(rows)
    assert len(out) == len(rows)
    source_of = {i: s for i, _, s in rows}
    taken = collections.Counter()
    for row in out:
        source = source_of[row.doc_id]
        assert row.source_size == sizes[source] and row.target == pytest.approx(targets[source])
        assert 0 <= row.taken <= 2 * row.size
        taken[source] += row.taken
    largest = max(r.size for r in out)
    assert all(abs(taken[s] - targets[s]) <= largest for s in sizes)
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix(frame.repartition(2)).collect()))
    mixed = mixing.mixed_documents(frame)
    assert mixed.columns == frame.columns
    copies = collections.Counter(r.doc_id for r in mixed.select("doc_id").collect())
    want = collections.Counter()
    for row in out:
        want[row.doc_id] += row.copies
    assert copies == +want
    assert mixing.mix(frame.limit(0)).collect() == [] and mixing.mixed_documents(frame.limit(0)).collect() == []


@pytest.fixture(scope="module")
def talks(spark):
    conversations = spark.read.parquet(f"{SMALL}/conversations.parquet")
    pieces = chat.raw_pieces(conversations)
    return conversations, pieces, chat.train(pieces.where(quality.fold(pieces["conv"], 5) != 0))


@pytest.mark.parametrize("chunk", [1_024, 2])
def test_roles_recovered(talks, chunk):
    conversations, pieces, model = talks
    got = {(r.conv, r.turn): (r.role, r.rendered) for r in chat.parse_transcripts(pieces, model, chunk=chunk).collect()}
    want = {(r.conv_id, r.turn): (r.role, f"<|{r.role}|>\n{r.text}\n<|end|>") for r in conversations.collect()}
    assert got == want


def test_one_long_transcript_and_odd_pieces(spark, talks):
    model = talks[2]
    turns = [("user" if i % 2 == 0 else "assistant", f"line {i} of a talk\nand more of it") for i in range(60)]
    raw = "".join(("\n" if i else "") + f"{r.title()}: {t}\n" for i, (r, t) in enumerate(turns))
    lines = raw.split("\n")
    # Pieces of five lines each: turns begin and end anywhere in them.
    rows = [(1, i // 5, "\n".join(lines[i : i + 5]) + "\n") for i in range(0, len(lines), 5)]
    rows += [(2, 0, None), (2, 1, "  \n"), (3, None, "User: hello\n\nAssistant:\n"), (None, 0, "Q: why?\nA: so.\n")]
    frame = spark.createDataFrame(rows, "conv bigint, position bigint, text string")
    for chunk in (1_024, 3):
        out = chat.parse_transcripts(frame, model, chunk=chunk).collect()
        by = {(r.conv, r.turn): (r.role, r.text) for r in out}
        assert len(by) == len(out)
        assert [by[1, i][0] for i in range(60)] == [r for r, _ in turns]
        assert all(by[1, i][1].replace("\n\n", "\n") == turns[i][1] for i in range(60))
        assert by[3, 0] == ("user", "hello") and by[3, 1] == ("assistant", "")
        assert by[None, 0] == ("user", "why?") and by[None, 1] == ("assistant", "so.")
        assert not any(r.conv == 2 for r in out)
    assert chat.parse_transcripts(frame.limit(0), model).collect() == []


def test_markers():
    assert chat.marker_of("User: hi") == (1, "hi") and chat.marker_of("### Assistant") == (2, "")
    assert chat.marker_of("<|system|>be kind") == (0, "be kind") and chat.marker_of("**AI:** yes") == (2, "yes")
    assert chat.marker_of("A of the") == (-1, "A of the") and chat.marker_of("Note: x") == (-1, "Note: x")


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    names, stages = zip(*corpus_pipeline.STAGES, strict=True)
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}

    clean = stages[0](spark, docs, SMALL)
    assert clean.columns == columns
    scores = {r.doc_id: r.score for r in toxicity.find_toxic(docs, toxicity.train(docs, labels)).collect()}
    ids = {r.doc_id for r in clean.collect()}
    assert ids == {i for i, s in scores.items() if s < 0.7}

    good = stages[1](spark, clean, SMALL)
    scores = {r.doc_id: r.score for r in quality.score_quality(clean, quality.train(clean, labels)).collect()}
    ids = {r.doc_id for r in good.collect()}
    assert ids == {i for i, s in scores.items() if s >= 0.3}

    def shingles(text):
        words = (text or "").encode().lower().split()
        return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))) if words else frozenset()

    single = stages[2](spark, good, SMALL)
    order = sorted(ids)
    sets = {i: shingles(rows[i].text) for i in order}
    low = {i: i for i in order}
    for i in order:
        for j in order:
            if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((low[i], low[j]))
                low = {k: a if v == b else v for k, v in low.items()}
    ids = {r.doc_id for r in single.collect()}
    assert ids == {i for i in order if low[i] == i}

    mixed = stages[3](spark, single, SMALL)
    assert mixed.columns == columns
    copies = collections.Counter(r.doc_id for r in mixed.collect())
    assert max(copies.values()) <= 2 and set(copies) <= ids
    sizes, targets = mix_by_hand([(i, rows[i].text, rows[i].source) for i in ids])
    taken = collections.Counter()
    for i, n in copies.items():
        taken[rows[i].source] += n * len((rows[i].text or "").split())
    longest = max(len((rows[i].text or "").split()) for i in ids)
    assert all(abs(taken[s] - targets[s]) <= longest for s in sizes)

    vocabulary = byte_bpe.load_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    want = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})
    out = corpus_pipeline.run(spark, SMALL).collect()
    assert collections.Counter(r.doc_id for r in out) == copies
    assert all(r.n_tokens == len(want.encode_ordinary(rows[r.doc_id].text or "")) for r in out)
    assert names == ("toxicity", "quality", "near_copies", "mixing", "byte_bpe")
