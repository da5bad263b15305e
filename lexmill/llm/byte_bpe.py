"""Byte-level BPE by prefix dynamic programming, and its inverse.

Every prefix of a piece has exactly one encoding, so one number per prefix is enough: its last
token. A token may follow another if merging their bytes gives just these two tokens again; the
last token of a prefix is the one that ends it and may follow the last token of what stands
before. Appending bytes only adds entries, and an edit leaves all entries before it valid.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.textkit import nothing_kept, slices

# Pieces, prefixes and pairs whose results a worker keeps; beyond that it starts anew.
KEEP_PIECES = 150_000
KEEP_PREFIXES = 120_000
KEEP_PAIRS = 150_000
# Longer pieces get a table of their own, of which nothing is kept.
KEEP_LENGTH = 64
# Ids decoded at a time.
DECODE_IDS = 1 << 20

_NEVER = 1 << 40
_HEAD = -1


class Vocabulary:
    """Ranks of byte strings; every single byte must have one."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no rank for the bytes {missing}")
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.start = max(self.bytes_of) + 1  # stands for the empty prefix
        self.longest = max(map(len, ranks))
        self._made: dict[bytes, tuple[bytes, bytes, int] | None] = {}
        self._spines: tuple[dict, dict] = ({}, {})
        self.pairs: dict[int, bool] = {}
        self.prefixes: dict[bytes, int] = {}
        self.pieces = _Pieces(self)

    @cached_property
    def known(self) -> dict[bytes, int]:
        """Every token's rank, and _HEAD for what only begins one."""
        return {token[:n]: _HEAD for token in self.ranks for n in range(1, len(token))} | self.ranks

    @cached_property
    def spelled(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All tokens' bytes in one array, and by id where each starts and how long it is."""
        start, size = np.zeros(self.start, dtype=np.int64), np.zeros(self.start, dtype=np.int64)
        at = 0
        for rank, token in self.bytes_of.items():
            start[rank], size[rank] = at, len(token)
            at += len(token)
        return np.frombuffer(b"".join(self.bytes_of.values()), dtype=np.uint8), start, size

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of a run of ids, and where each id's end."""
        letters, start, size = self.spelled
        lengths = size[ids]
        ends = np.cumsum(lengths)
        place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(ends - lengths, lengths)
        return letters[np.repeat(start[ids], lengths) + place], ends

    def forget(self) -> None:
        """Let go of everything that was kept."""
        for kept in (self.pieces, self.prefixes, self.pairs, self._made, *self._spines):
            kept.clear()

    def _merged(self, data: bytes, down_to: int) -> list[bytes]:
        """Merge the lowest rank, leftmost first, until `down_to` parts are left or none can merge."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > down_to:
            best, at = _NEVER, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1], _NEVER)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _origin(self, token: bytes) -> tuple[bytes, bytes, int] | None:
        """The two tokens whose merge makes this one and the rank at which it exists; None if merges never make it."""
        if token not in self._made:
            if len(token) == 1:
                self._made[token] = (b"", b"", -1)
            else:
                parts = self._merged(token, 2)
                made = None
                if len(parts) == 2:
                    ends = self._origin(parts[0]), self._origin(parts[1])
                    if ends[0] is not None and ends[1] is not None:
                        made = (parts[0], parts[1], max(self.ranks[token], ends[0][2], ends[1][2]))
                self._made[token] = made
        return self._made[token]

    def _spine(self, token: bytes, side: int) -> list[tuple[bytes, int, int]]:
        """The tokens at one end of a token while it is merged: (token, made at, used up at)."""
        kept = self._spines[side]
        if token not in kept:
            spine, until, at = [], _NEVER, token
            while at:
                made = self._origin(at)
                spine.append((at, made[2], until))
                at, until = made[side], made[2]
            kept[token] = spine
        return kept[token]

    def may_follow(self, first: int, second: int) -> bool:
        """Whether merging the bytes of both tokens leaves exactly these two.

        It does not if a token at the end of `first` and one at the start of `second` exist at
        the same time and can merge before either is used up; of equal ranks the left one wins.
        After the empty prefix stands any token that merges can make.
        """
        token = self.bytes_of[second]
        apart = self._origin(token) is not None
        if apart and first != self.start:
            apart = self._apart(self.bytes_of[first], token)
        if len(self.pairs) >= KEEP_PAIRS:
            self.pairs.clear()
        self.pairs[first << 32 | second] = apart
        return apart

    def _apart(self, first: bytes, second: bytes) -> bool:
        starts = self._spine(second, 0)
        for tail, made_a, used_a in self._spine(first, 1):
            for head, made_b, used_b in starts:
                if made_a <= used_b and made_b < used_a:
                    rank = self.ranks.get(tail + head)
                    if rank is not None and rank < used_a and rank <= used_b:
                        return False
        return True

    def last_token(self, prefix: bytes) -> int:
        """The last token of a prefix's encoding, which many pieces share.

        It is the only token at the prefix's end that may follow the last token of what stands
        before it; longer ones are tried first.
        """
        token = self.prefixes.get(prefix)
        if token is not None:
            return token
        size = len(prefix)
        for start in range(max(0, size - self.longest), size):
            token = self.ranks.get(prefix[start:])
            if token is not None:
                before = self.last_token(prefix[:start]) if start else self.start
                follows = self.pairs.get(before << 32 | token)
                if follows is None:
                    follows = self.may_follow(before, token)
                if follows:
                    break
        self.prefixes[prefix] = token
        return token

    def _by_prefixes(self, data: bytes) -> list[int]:
        if len(self.prefixes) >= KEEP_PREFIXES:
            self.prefixes.clear()
        found, bytes_of = [], self.bytes_of
        while data:
            token = self.last_token(data)
            found.append(token)
            data = data[: -len(bytes_of[token])]
        found.reverse()
        return found

    def encode_piece(self, text: str) -> list[int]:
        """The ids of one piece; a piece that is itself a token is that token."""
        data = text.encode()
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        return self._by_prefixes(data) if len(data) <= KEEP_LENGTH else PrefixTable(self, data).ids()


class _Pieces(dict):
    """Pieces and their ids as 32-bit numbers; what is missing is encoded and kept."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.encode = vocabulary.encode_piece

    def __missing__(self, text: str) -> bytes:
        ids = array("i", self.encode(text)).tobytes()
        if len(text) <= KEEP_LENGTH:
            if len(self) >= KEEP_PIECES:
                self.clear()
            self[text] = ids
        return ids


class PrefixTable:
    """The last token of every prefix of a piece that grows at its end."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = [vocabulary.start]
        if data:
            self.append(data)

    def append(self, more: bytes) -> None:
        """Add bytes; the entries of earlier prefixes stay as they are."""
        v, old = self.vocabulary, len(self.data)
        self.data = data = self.data + more
        self.last.extend([-1] * len(more))
        last, known, pairs, size = self.last, v.known.get, v.pairs.get, len(data)
        # A token that ends behind `old` starts less than the longest token before it.
        for start in range(max(0, old - v.longest), size):
            before = last[start]
            key = before << 32
            for stop in range(start + 1, size + 1):
                token = known(data[start:stop])
                if token is None:
                    break
                if token >= 0 and last[stop] < 0:
                    follows = pairs(key | token)
                    if follows is None:
                        follows = v.may_follow(before, token)
                    if follows:
                        last[stop] = token

    def cut(self, length: int) -> None:
        """Keep the first `length` bytes."""
        self.data = self.data[:length]
        del self.last[length + 1 :]

    def ids(self) -> list[int]:
        """The encoding, read backwards from the last token."""
        last, bytes_of, at, found = self.last, self.vocabulary.bytes_of, len(self.data), []
        while at:
            token = last[at]
            found.append(token)
            at -= len(bytes_of[token])
        found.reverse()
        return found


class EncodedText:
    """A text's pieces and ids, kept so that an edit encodes only what it touches."""

    def __init__(self, text: str, vocabulary: Vocabulary, pattern: str) -> None:
        self.vocabulary, self.split = vocabulary, regex.compile(pattern)
        self.text = text
        self.spans = [m.span() for m in self.split.finditer(text)]
        self.pieces = [vocabulary.encode_piece(text[a:b]) for a, b in self.spans]

    def edit(self, start: int, stop: int, new: str) -> int:
        """Replace text[start:stop]; returns the number of pieces that were encoded.

        A match looks up to two characters past its end (an apostrophe at 'll, blanks at what
        follows them), so pieces that end at least two before the edit stay. The text is split
        from there until a match starts where, behind the edit, an old one started.
        """
        keep = 0
        while keep < len(self.spans) and self.spans[keep][1] + 2 <= start:
            keep += 1
        text = self.text[:start] + new + self.text[stop:]
        shift = len(new) - (stop - start)
        old = {a + shift: i for i, (a, _) in enumerate(self.spans) if a >= stop}
        at = self.spans[keep - 1][1] if keep else 0
        spans, tail = [], len(self.spans)
        for m in self.split.finditer(text, at):
            if m.start() >= start + len(new) and m.start() in old:
                tail = old[m.start()]
                break
            spans.append(m.span())
        self.text = text
        self.pieces[keep:tail] = [self.vocabulary.encode_piece(text[a:b]) for a, b in spans]
        self.spans = self.spans[:keep] + spans + [(a + shift, b + shift) for a, b in self.spans[tail:]]
        return len(spans)

    def append(self, more: str) -> int:
        return self.edit(len(self.text), len(self.text), more)

    def ids(self) -> list[int]:
        return list(chain.from_iterable(self.pieces))


def read_vocabulary(path: str) -> Vocabulary:
    """Read a rank file: base64 bytes and a rank on each line."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            token, _, rank = line.partition(b" ")
            if rank:
                ranks[base64.b64decode(token)] = int(rank)
    return Vocabulary(ranks)


@lru_cache(maxsize=1)
def load_vocabulary(path: str) -> Vocabulary:
    """A worker reads a rank file once, whatever the number of its tasks."""
    return read_vocabulary(path)


def encode_text(text: str, vocabulary: Vocabulary, split: regex.Pattern) -> np.ndarray:
    """The ids of a whole text, each match of `split` encoded by itself."""
    return np.frombuffer(b"".join(map(vocabulary.pieces.__getitem__, split.findall(text))), dtype=np.int32)


def encode_documents(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, ids) of every whole text, each match of `pattern` encoded by itself.

    NULL and empty texts have no ids; repeated rows repeat; an empty table gives none. Every
    row is worked on by itself, so nothing is shuffled and a lost task is simply run again. The
    rank file must be readable at `path` on every executor.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, split = load_vocabulary(path), regex.compile(pattern)
        with nothing_kept(vocabulary.forget):
            for batch in batches:
                for part in slices(batch):
                    found = [encode_text(t or "", vocabulary, split) for t in part.column(1).to_pylist()]
                    ends = np.cumsum([0, *map(len, found)], dtype=np.int64).astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
                    yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["doc_id", "ids"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """`encoded` with the column `decoded`: the bytes that the ids stand for. NULL ids give none."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load_vocabulary(path)
        for batch in batches:
            lists = batch.column(batch.schema.names.index("ids"))
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            after = np.cumsum(sizes)
            row = 0
            while row < batch.num_rows:
                stop = int(np.searchsorted(after, (after[row - 1] if row else 0) + DECODE_IDS, side="right"))
                stop = min(max(stop, row + 1), batch.num_rows)
                part = batch.slice(row, stop - row)
                letters, ends = vocabulary.decode(lists.slice(row, stop - row).flatten().to_numpy(zero_copy_only=False))
                cuts = np.concatenate([[0], np.concatenate([[0], ends])[np.cumsum(sizes[row:stop])]])
                whole = letters.tobytes()
                texts = [whole[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=[*part.schema.names, "decoded"])
                row = stop

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(decode, f"{fields}, decoded binary")


def digest_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): what `encode_documents` and `decode_documents` give, as digests.

    One pass encodes each text, decodes its ids and hashes both, so neither ids nor bytes leave
    the task. The first digest is of the decimal ids joined by commas. NULL and empty texts have
    no ids; the digests are those of the empty string.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, split = load_vocabulary(path), regex.compile(pattern)
        with nothing_kept(vocabulary.forget):
            decimals = [b"%d" % i for i in range(vocabulary.start)]
            for batch in batches:
                for part in slices(batch):
                    sizes, ids_hex, bytes_hex = [], [], []
                    for text in part.column(1):
                        ids = encode_text(text.as_py() or "", vocabulary, split)
                        letters = vocabulary.decode(ids)[0]
                        sizes.append(len(ids))
                        ids_hex.append(hashlib.sha256(b",".join(map(decimals.__getitem__, ids.tolist()))).hexdigest())
                        bytes_hex.append(hashlib.sha256(letters.tobytes()).hexdigest())
                    columns = [part.column(0), pa.array(sizes, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(bytes_hex, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(digest, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
