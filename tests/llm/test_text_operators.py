"""Tokens, fingerprints, licences and language-model scores against brute force."""

import collections
import functools
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from lexmill.llm import byte_bpe, fingerprints, licenses, suffix_model
from lexmill.llm.textkit import Words, slices, text_bytes, words_of

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
TEXTS = [
    "The quick brown fox.\nThe quick brown fox.", "", None, "   \n\t ", "word", "Ünï — 中文 🙂 text", "a" * 3_000,
    "Released under the MIT License. Licensed under the Apache License, Version 2.0.", "under the mit license " * 3,
    "under the mit", "cc by nc cc by nc", "CC BY-NC 4.0", "This work is licensed under the GNU General Public License, version 3.",
    " ".join(f"w{i % 97}" for i in range(5_000)), "same text here", "same text here",
]
# Columns whose names the operators also use inside.
SCHEMA = "doc_id bigint, text string, key string, hash string, range int, guest boolean, n bigint, words string, ids string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3, t, "k", "h", 1, True, 7, "w", "i") for i, t in enumerate(TEXTS)]
    rows += [rows[-1], (None, "no id", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def tokenizer():
    vocabulary = byte_bpe.load_vocabulary(PATH)
    return vocabulary, tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


letters = st.text(st.characters(exclude_categories=["Cs"]), max_size=60) | st.text("the ingaon\n' 19éß", max_size=120)


@settings(max_examples=400, deadline=None)
@given(letters)
def test_words_match_python(text):
    column = pa.array([text, None, text + " x"])
    words = Words(*text_bytes(column))
    want = [w for t in (text, "", text + " x") for w in t.encode().lower().split()]
    assert [words.text(i) for i in range(len(words.hashes))] == want
    seen = {}
    for w, h in zip(want, words.hashes.tolist(), strict=True):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_shingles_of_short_and_long_texts():
    batch = pa.RecordBatch.from_pydict({"text": ["a b c d e", "A B", "a  b", "", None, "a b c d", "b a"]})
    doc, hashes = words_of(batch).shingles(4)
    by = collections.defaultdict(set)
    for d, h in zip(doc.tolist(), hashes.tolist(), strict=True):
        by[d].add(h)
    assert [len(by[i]) for i in range(7)] == [2, 1, 1, 0, 0, 1, 1]
    assert by[1] == by[2] and by[5] < by[0] and by[6] != by[1]
    assert [p.num_rows for p in slices(batch, limit=4)] == [1, 1, 3, 1, 1]


@settings(max_examples=400, deadline=None)
@given(letters)
def test_bpe_matches_reference_library(tokenizer, text):
    vocabulary, want = tokenizer
    assert byte_bpe.encode_text(text, vocabulary, regex.compile(PATTERN)).tolist() == want.encode_ordinary(text)


def test_bpe_long_piece_and_every_prefix(tokenizer):
    vocabulary, want = tokenizer
    rnd = random.Random(3)
    piece = "".join(rnd.choice("theingaon") for _ in range(400))
    table = byte_bpe.PrefixTable(vocabulary)
    for start in range(0, 400, 7):
        table.append(piece[start : start + 7].encode())
    assert table.ids() == want.encode_ordinary(piece)
    for cut in (399, 250, 90, 1, 0):
        table.cut(cut)
        assert table.ids() == want.encode_ordinary(piece[:cut])


@settings(max_examples=200, deadline=None)
@given(st.text(" abc\n'19é", max_size=50), st.data())
def test_bpe_edits(tokenizer, text, data):
    vocabulary, want = tokenizer
    start = data.draw(st.integers(0, len(text)))
    stop = data.draw(st.integers(start, len(text)))
    new = data.draw(st.text(" ab\n1é", max_size=6))
    state = byte_bpe.EncodedText(text, vocabulary, PATTERN)
    state.edit(start, stop, new)
    state.append(" end")
    assert state.ids() == want.encode_ordinary(text[:start] + new + text[stop:] + " end")


@settings(max_examples=400, deadline=None)
@given(st.text(" a'lrevstmd\n1", max_size=14), st.data())
def test_bpe_edits_beside_endings_and_blanks(tokenizer, text, data):
    vocabulary, want = tokenizer
    start = data.draw(st.integers(0, len(text)))
    stop = data.draw(st.integers(start, len(text)))
    new = data.draw(st.text(" a'lrevstmd\n", max_size=3))
    state = byte_bpe.EncodedText(text, vocabulary, PATTERN)
    state.edit(start, stop, new)
    text = text[:start] + new + text[stop:]
    assert state.spans == [m.span() for m in regex.finditer(PATTERN, text)]
    assert state.ids() == want.encode_ordinary(text)


@pytest.mark.parametrize("text", ["we'll", "we're", "we've", "a\n  b", "a   \n"])
def test_bpe_appends_letter_by_letter(tokenizer, text):
    vocabulary, want = tokenizer
    state = byte_bpe.EncodedText("", vocabulary, PATTERN)
    for end, letter in enumerate(text, 1):
        state.append(letter)
        assert state.ids() == want.encode_ordinary(text[:end])
        assert state.spans == [m.span() for m in regex.finditer(PATTERN, text[:end])]


def test_bpe_edit_encodes_little(tokenizer):
    state = byte_bpe.EncodedText("some words here " * 500, tokenizer[0], PATTERN)
    assert state.edit(4_000, 4_001, "xyz") < 6


def test_bpe_over_documents(docs, empty, tokenizer):
    out = byte_bpe.decode_documents(byte_bpe.encode_documents(docs, PATH, PATTERN), PATH).collect()
    assert len(out) == len(TEXTS) + 2
    texts = {i * 3: t or "" for i, t in enumerate(TEXTS)} | {None: "no id"}
    for row in out:
        assert row.ids == tokenizer[1].encode_ordinary(texts[row.doc_id])
        assert bytes(row.decoded) == texts[row.doc_id].encode()
    assert byte_bpe.encode_documents(empty, PATH, PATTERN).collect() == []


def test_bpe_digests_equal_ids_and_bytes(docs, empty):
    """One pass gives what encoding and decoding by themselves give, NULL, repeated and id-less rows included."""
    both = byte_bpe.decode_documents(byte_bpe.encode_documents(docs, PATH, PATTERN), PATH).collect()
    sha = lambda data: hashlib.sha256(data).hexdigest()
    want = collections.Counter((r.doc_id, len(r.ids), sha(",".join(map(str, r.ids)).encode()), sha(bytes(r.decoded))) for r in both)
    assert collections.Counter(tuple(r) for r in byte_bpe.digest_documents(docs, PATH, PATTERN).collect()) == want
    assert byte_bpe.digest_documents(empty, PATH, PATTERN).collect() == []


def test_licenses_against_brute_force(docs, empty):
    out = licenses.summary(licenses.scan_licenses(docs)).collect()
    texts = {i * 3: t for i, t in enumerate(TEXTS)} | {None: "no id"}
    assert len(out) == len(TEXTS) + 2
    lower = str.maketrans(licenses.UPPER, licenses.LOWER)
    for row in out:
        words = re.findall(licenses.WORD_PATTERN, (texts[row.doc_id] or "").translate(lower))
        base, labels = [], set()
        for t in licenses.TEMPLATES:
            key = t.key.split()
            places = [i for i in range(len(words)) if words[i : i + len(key)] == key]
            labels |= {t.label} if places else set()
            base += [(i, t.label) for i in places] if t.base else []
        starts = [i for i, _ in base]
        assert row.n_words == len(words) and row.n_base == len(base)
        assert (row.first_word, row.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert row.base_labels == ",".join(sorted({x for _, x in base})) and row.labels == ",".join(sorted(labels))
        assert 0 <= row.score <= 1 and (row.score > 0) == bool(labels)
    assert licenses.summary(licenses.scan_licenses(empty)).collect() == []


def test_simhash_contract(docs, empty, spark):
    named = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(named).collect()}
    texts = {i * 3: t or "" for i, t in enumerate(TEXTS)}
    order = sorted(texts, reverse=True)
    for at, i in enumerate(order):
        text, after = texts[i], order[(at + 1) % len(order)]
        third = len(text) // 3
        edited = text[: len(text) - third] + texts[after][:third]
        row = got[i]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        alike = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / fingerprints.BITS
        assert row.near_edited == alike(row.fingerprint, row.edited_fingerprint)
        assert row.near_next == alike(row.fingerprint, got[after].fingerprint)
        near = sum((int(row.fingerprint, 16) ^ int(o.fingerprint, 16)).bit_count() <= 3 for o in got.values()) - 1
        assert row.n_near == near
    assert len({got[i].fingerprint for i in order if texts[i] == "same text here"}) == 1
    everything = fingerprints.edited_fingerprints(docs).collect()
    assert len(everything) == len(TEXTS) + 2
    assert fingerprints.edited_fingerprints(empty).collect() == []
    single = fingerprints.edited_fingerprints(spark.createDataFrame([(1, "abcdef")], "doc_id bigint, text string")).first()
    assert single.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


def test_block_tables_find_all_pairs(spark):
    rnd = np.random.default_rng(5)
    prints = rnd.integers(-(2**62), 2**62, (60, 2), dtype=np.int64).tolist()
    for base in list(prints[:20]):
        for _ in range(3):
            bits = [int(b) & (2**64 - 1) for b in base]
            for at in rnd.choice(128, int(rnd.integers(1, 6)), replace=False).tolist():
                bits[at // 64] ^= 1 << (at % 64)
            prints.append([b - 2**64 if b >= 2**63 else b for b in bits])
    prints = sorted({tuple(p) for p in prints})
    frame = spark.createDataFrame(prints, "high bigint, low bigint")
    far = lambda a, b: sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(a, b, strict=True))
    for radius, chunk in ((1, 2048), (3, 2048), (10, 2048), (10, 6)):
        got = [((r.high, r.low), (r.high2, r.low2)) for r in fingerprints.near_pairs(frame, radius, chunk).collect()]
        assert len(got) == len(set(got))
        assert set(got) == {(a, b) for a in prints for b in prints if a < b and far(a, b) <= radius}


def test_more_fingerprints_take_more_selective_tables(spark, monkeypatch):
    sizes = [len(fingerprints.tables_for(n, 10)) for n in (10, 10**6, 10**8, 10**10)]
    assert sizes == sorted(sizes) and sizes[0] == 11 and len(set(sizes)) > 2
    rnd = np.random.default_rng(9)
    base = rnd.integers(-(2**62), 2**62, (12, 2), dtype=np.int64)
    rows = np.repeat(base, 10, axis=0)
    rows[:, 0] ^= rnd.integers(0, 2**62, 120) & rnd.integers(0, 2**62, 120) & rnd.integers(0, 2**62, 120) & rnd.integers(0, 2**62, 120)
    frame = spark.createDataFrame(rows.tolist(), "high bigint, low bigint")
    counts = []
    for cost in (0.0025, 1e9):
        monkeypatch.setattr(fingerprints, "PAIR_COST", cost)
        counts.append(sorted(tuple(r) for r in fingerprints.near_counts(frame, chunk=5).collect()))
    assert counts[0] == counts[1]
    far = lambda a, b: sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(a, b, strict=True))
    assert {(h, lo): n for h, lo, _, n in counts[0]} == {tuple(a): sum(far(a, b) <= 10 for b in rows.tolist()) - 1 for a in rows.tolist()}


def test_near_counts_of_changed_copies(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(30):
        words = [f"w{rnd.randint(0, 2_000)}" for _ in range(200)]
        rows.append((2 * i, " ".join(words)))
        words[rnd.randrange(200)] = "changed"
        rows.append((2 * i + 1, " ".join(words)))
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    far = lambda a, b: (int(got[a].fingerprint, 16) ^ int(got[b].fingerprint, 16)).bit_count()
    for i in got:
        assert got[i].n_near == sum(far(i, j) <= fingerprints.RADIUS for j in got if j != i)
    assert sum(got[2 * i].n_near > 0 for i in range(30)) >= 25


def test_suffix_tree_scores(docs, empty, spark):
    got = suffix_model.suffix_scores(docs).collect()
    texts = {i * 3: t for i, t in enumerate(TEXTS)} | {None: "no id"}
    of = lambda i: (texts[i] or "").encode().lower().split() + [None]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts = collections.Counter()
    for row in docs.select("doc_id").collect():
        if not held(row.doc_id):
            counts.update(of(row.doc_id))
    tokens, types = sum(counts.values()), len(counts)
    assert len(got) == len(TEXTS) + 2
    for row in got:
        words = of(row.doc_id)
        assert (row.held_out, row.n_tokens, row.train_tokens) == (held(row.doc_id), len(words), tokens)
        assert row.n_known == sum(counts[w] > 0 for w in words)
        base = sum(math.log10((counts[w] + 1) / (tokens + types + 1)) for w in words)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert row.score <= 1e-9
    nothing = suffix_model.suffix_scores(spark.createDataFrame([(next(i for i in range(99) if held(i)), "a b")], "doc_id bigint, text string")).first()
    assert (nothing.train_tokens, nothing.n_known, nothing.base_score, nothing.score) == (0, 0, 0.0, 0.0)
    assert suffix_model.suffix_scores(empty).collect() == []


def test_suffix_tree_learns_contexts(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(400):
        words = []
        while len(words) < 60:
            words += rnd.choice([["a", "b", "c"], ["x", "b", "d"], ["e"], [f"r{rnd.randint(0, 50)}"]])
        rows.append((i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    scored = [r for r in suffix_model.suffix_scores(frame).collect() if r.held_out]
    assert sum(r.score for r in scored) > 0.8 * sum(r.base_score for r in scored)


def suffix_tree(texts):
    """(chance, rest, counts): the tree of lists of words, grown as long as a shorter context of late was kept, in plain loops."""
    seen = collections.defaultdict(collections.Counter)
    longest = max(map(len, texts))
    for words in texts:
        for k in range(1, min(longest, 9) + 1):
            seen[k].update(tuple(words[a : a + k]) for a in range(len(words) - k + 1))
    tokens, types, rest = sum(seen[1].values()), len(seen[1]), {}

    @functools.cache
    def share(run):
        n = seen[len(run)][run]
        return (n - suffix_model.DISCOUNT) / seen[len(run) - 1][run[:-1]] if n >= suffix_model.MIN_NEXT else 0.0

    def chance(run):
        while len(run) > 1 and run[:-1] not in rest:
            run = run[1:]
        if len(run) == 1:
            return (seen[1][run] + 1) / (tokens + types + 1)
        return share(run) + rest[run[:-1]] * chance(run[1:])

    after = collections.defaultdict(list)
    for k in range(2, 10):
        for run in seen[k]:
            after[run[:-1]].append(run)
    contexts = [c for c, n in seen[1].items() if n >= suffix_model.MIN_CONTEXT and c != (None,)]
    idle = dict.fromkeys(contexts, 0)
    while contexts:
        kept, further, since = {}, [], {}
        for context in contexts:
            runs = [r for r in after[context] if seen[len(r)][r] >= suffix_model.MIN_NEXT]
            if not runs:
                continue
            further += [r for r in runs if seen[len(r)][r] >= suffix_model.MIN_CONTEXT and r[-1] is not None]
            left, lower = 1 - sum(map(share, runs)), {r: chance(r[1:]) for r in runs}
            mixed = {r: share(r) + left * lower[r] for r in runs}
            gain = sum(p * math.log(p / lower[r]) for r, p in mixed.items()) + left * (1 - sum(lower.values())) * math.log(left)
            if seen[len(context)][context] * gain >= suffix_model.MIN_GAIN:
                kept[context] = left
            since[context] = 0 if context in kept else idle[context] + 1
        rest |= kept
        idle = {r: since[r[1:]] for r in further if since.get(r[1:], 9) < suffix_model.PATIENCE}
        contexts = list(idle)
    return chance, rest, seen[1]


@pytest.mark.parametrize("share", [None, 0.01, 2.0])
def test_suffix_tree_keeps_rare_long_and_hot_contexts(spark, monkeypatch, share):
    """Against brute force, whatever is broadcast and whatever is joined."""
    if share:
        monkeypatch.setattr(suffix_model, "WORD_SHARE", share)
        monkeypatch.setattr(suffix_model, "HOT_WEIGHTS", 0 if share > 1 else 50)
        monkeypatch.setattr(suffix_model, "GATHER", 700)
    rnd = random.Random(2)
    rows = []
    for i in range(300):
        words = []
        while len(words) < 40:
            # The word after "m n" depends on the one before, that after "e f g" on the third before;
            # "q0 r0" and so on are rare; "hot" stands before everything.
            side, k = rnd.choice("uv"), rnd.randint(0, 30)
            words += rnd.choice([
                [side, "m", "n", side * 2], [f"q{k}", f"r{k}", f"s{k}"], [f"z{rnd.randint(0, 60)}"], ["m", "n"], ["hot", f"w{rnd.randint(0, 200)}"],
                [side * 3, "e", "f", "g", side * 4],
            ])
        rows.append((i, " ".join(words)))
    texts = [t.split() + [None] for _, t in rows]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    chance, rest, counts = suffix_tree([words for words, out in zip(texts, held, strict=True) if not out])
    assert ("hot",) in rest and any(len(c) == 4 for c in rest)
    for context in [c for c in rest if len(c) > 1][:20]:
        unseen = 1 / (sum(counts.values()) + len(counts) + 1)
        for a in range(len(context)):
            unseen *= rest.get(context[a:], 1.0)
        assert sum(chance((*context, w)) for (w,) in counts) + unseen == pytest.approx(1)
    got = suffix_model.suffix_scores(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    for row in got:
        words = texts[row.doc_id]
        want = sum(math.log10(chance(tuple(words[max(0, a - 8) : a + 1]))) for a in range(len(words)))
        assert row.score == pytest.approx(want, rel=1e-9)
