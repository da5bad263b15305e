"""Roles of raw chat transcripts by a hidden Markov model, and canonical turns."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.session import cut_lineage

ROLES = ("system", "user", "assistant")
# Names that speakers are given at the beginning of a line.
NAMES = {
    "system": ("system", "context", "instruction"),
    "user": ("user", "human", "customer", "q"),
    "assistant": ("assistant", "ai", "bot", "model", "a"),
}
# Pieces of a transcript that a task works on together.
CHUNK = 1_024
# A line's length in characters from which it counts as long.
LONG_LINE = 60

_ROLE_OF = {name: i for i, role in enumerate(ROLES) for name in NAMES[role]}
_MARKER = re.compile(
    r"(?:\#{1,6}[ ]*(?P<head>\w+)[ ]*:?[ ]*$|<\|?(?P<tag>\w+)\|?>[ ]*|\[(?P<box>\w+)\][ ]*:?[ ]*|\*\*(?P<bold>\w+):?\*\*:?[ ]*|(?P<plain>\w+):(?:[ ]+|$))"
)
SYMBOLS = 32
# States: the first line of a turn of each role, then its further lines.
STATES = 2 * len(ROLES)
_IMPOSSIBLE = -1e30


class Model(NamedTuple):
    """Log-probabilities: of the first state, of a state after another, of a symbol in a state."""

    first: np.ndarray
    move: np.ndarray
    show: np.ndarray


class Line(NamedTuple):
    text: str
    marker: int
    after_blank: bool
    said: str


def marker_of(line: str) -> tuple[int, str]:
    """(role, rest): the role that a line's marker names, and the line without it; (-1, line) without one."""
    found = _MARKER.match(line)
    role = _ROLE_OF.get(next(filter(None, found.groups())).lower(), -1) if found else -1
    return (role, line[found.end() :]) if role >= 0 else (-1, line)


def lines_of(text: str | None) -> list[Line]:
    """The lines of a piece that are not blank."""
    found, blank = [], False
    for line in (text or "").split("\n"):
        if line.strip():
            marker, said = marker_of(line)
            found.append(Line(line, marker, blank, said))
            blank = False
        else:
            blank = True
    return found


def symbol(line: Line) -> int:
    """What the model sees of a line: its marker, a blank line ahead, a question at its end, its length."""
    return (line.marker + 1) * 8 + line.after_blank * 4 + line.text.rstrip().endswith("?") * 2 + (len(line.text) >= LONG_LINE)


def viterbi(symbols: np.ndarray, model: Model, enter: int | None, leave: int | None) -> np.ndarray:
    """The likeliest states of a run of lines, after state `enter` (None: a beginning) and ending in `leave` if given."""
    n = len(symbols)
    back = np.zeros((n, STATES), dtype=np.int8)
    best = (model.first if enter is None else model.move[enter]) + model.show[:, symbols[0]]
    for t in range(1, n):
        reach = best[:, None] + model.move
        back[t] = reach.argmax(axis=0)
        best = reach.max(axis=0) + model.show[:, symbols[t]]
    states = np.zeros(n, dtype=np.int8)
    states[-1] = best.argmax() if leave is None else leave
    for t in range(n - 1, 0, -1):
        states[t - 1] = back[t, states[t]]
    return states


def transfer(symbols: np.ndarray, model: Model) -> np.ndarray:
    """Best log-probability of a run of lines from each state before it (last row: a beginning) to each at its end."""
    start = np.vstack([model.move, model.first[None, :]]) + model.show[:, symbols[0]][None, :]
    for s in symbols[1:]:
        start = (start[:, :, None] + model.move[None, :, :]).max(axis=1) + model.show[:, s][None, :]
    return start


def train(pieces: DataFrame, conv: str = "conv", position: str = "position", text: str = "text", role: str = "role") -> Model:
    """Count states and features of lines in pieces that are one turn each, of a known role.

    A line shows, independently of each other, a marker (none, its own role's, another's), a
    blank line ahead, and its shape; the first two depend only on whether it begins a turn.
    One row per kind of event and task is shuffled; the result has a fixed number of entries.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for body, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name in ROLES:
                    r = ROLES.index(name)
                    found = lines_of(body)
                    for i, line in enumerate(found):
                        state = r if i == 0 else r + len(ROLES)
                        relation = 0 if line.marker < 0 else 1 if line.marker == r else 2
                        seen["marker", int(i > 0), relation] += 1
                        seen["blank", int(i > 0), int(line.after_blank)] += 1
                        seen["shape", state, symbol(line) % 4] += 1
                        seen["stay", state, int(i + 1 < len(found))] += 1
        kind, s, k = zip(*seen, strict=True) if seen else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.string()), pa.array(s, pa.int32()), pa.array(k, pa.int32()), pa.array(list(seen.values()), pa.int64())],
            names=["kind", "state", "what", "n"],
        )

    counted = pieces.select(F.col(text).alias("text"), F.col(role).alias("role")).mapInArrow(count, "kind string, state int, what int, n bigint")
    turns = pieces.where(F.col(role).isin(*ROLES)).select(F.col(conv).alias("conv"), F.col(position).alias("position"), F.col(role).alias("role"))
    order = Window.partitionBy("conv", F.floor(F.col("position") / CHUNK)).orderBy("position")
    follow = turns.select("role", F.lag("role").over(order).alias("before"), "position")
    moved = follow.groupBy("before", "role", (F.col("position") == 0).alias("opens")).agg(F.count(F.lit(1)).alias("n")).collect()
    tables = {"marker": np.full((2, 3), 0.5), "blank": np.full((2, 2), 0.5), "shape": np.full((STATES, 4), 0.5), "stay": np.full((STATES, 2), 0.5)}
    for row in counted.groupBy("kind", "state", "what").agg(F.sum("n").alias("n")).collect():
        tables[row["kind"]][row["state"], row["what"]] += row["n"]
    marker, blank, shape, stay = (t / t.sum(axis=1, keepdims=True) for t in tables.values())
    show = np.empty((STATES, SYMBOLS))
    for s in range(STATES):
        for k in range(SYMBOLS):
            named = k // 8 - 1
            relation = 0 if named < 0 else 1 if named == s % len(ROLES) else 2
            later = int(s >= len(ROLES))
            show[s, k] = marker[later, relation] * blank[later, k // 4 % 2] * shape[s, k % 4]
    opening, turn = np.full(len(ROLES), 0.1), np.full((len(ROLES), len(ROLES)), 0.1)
    for row in moved:
        if row["opens"]:
            opening[ROLES.index(row["role"])] += row["n"]
        elif row["before"] is not None:
            turn[ROLES.index(row["before"]), ROLES.index(row["role"])] += row["n"]
    first = np.concatenate([opening / opening.sum(), np.zeros(len(ROLES))])
    move = np.zeros((STATES, STATES))
    for s in range(STATES):
        r = s % len(ROLES)
        on = stay[s, 1]
        move[s, r + len(ROLES)] = on
        move[s, : len(ROLES)] = (1 - on) * turn[r] / turn[r].sum()
    logs = [np.where(x > 0, np.log(np.maximum(x, 1e-300)), _IMPOSSIBLE) for x in (first, move, show)]
    return Model(*logs)


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """(key, rows) for rows that arrive sorted by their first `keys` columns."""
    current, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != current:
                if held:
                    yield current, held
                current, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield current, held


def parse_transcripts(
    pieces: DataFrame, model: Model, conv: str = "conv", position: str = "position", text: str = "text", chunk: int = CHUNK
) -> DataFrame:
    """(conv, turn, role, text, rendered): the turns of every transcript.

    A transcript comes in pieces that end at line ends, in the order of `position`; where turns
    begin need not agree with them. Each chunk of pieces is reduced to the best
    log-probabilities between the states at its ends, those are joined along a transcript, and
    each chunk's states follow from the states at its ends: the exact Viterbi path, though no
    task holds more of a transcript than a chunk, or one small matrix per chunk. Blank pieces
    leave no turn; a marker without text leaves an empty turn; blank lines inside a turn stay
    one blank line. Pieces at the same position follow each other in the order of their text.
    A NULL `conv` is a transcript like any other; a NULL position comes first.
    """
    shared = pieces.sparkSession.sparkContext.broadcast(tuple(model))
    place = F.coalesce(F.col(position), F.lit(-1)).cast("bigint")
    rows = pieces.select(
        F.col(conv).alias("conv"), F.floor(place / F.lit(chunk)).cast("bigint").alias("chunk"), place.alias("position"), F.col(text).alias("text")
    )
    kind = rows.schema["conv"].dataType.simpleString()
    id_type = pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()
    dealt = rows.repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "position", "text")

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        out: list[tuple] = []
        for (name, number), run in _runs(batches, 2):
            symbols = np.array([symbol(x) for _, body in run for x in lines_of(body)], dtype=np.int64)
            if len(symbols):
                out.append((name, number, transfer(symbols, own).ravel().tolist()))
            if len(out) >= 1_000:
                yield table(out)
                out = []
        if out:
            yield table(out)

    def table(out: list[tuple]) -> pa.RecordBatch:
        names, numbers, values = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(names, id_type), pa.array(numbers, pa.int64()), pa.array(values, pa.list_(pa.float64()))], names=["conv", "chunk", "best"]
        )

    matrices = cut_lineage(dealt.mapInArrow(reduce, f"conv {kind}, chunk bigint, best array<double>"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (name,), run in _runs(batches, 1):
            best, back = None, []
            for _, values in run:
                matrix = np.array(values).reshape(STATES + 1, STATES)
                if best is None:
                    best = matrix[-1]
                    back.append(np.full(STATES, -1, dtype=np.int8))
                else:
                    reach = best[:, None] + matrix[:-1]
                    back.append(reach.argmax(axis=0).astype(np.int8))
                    best = reach.max(axis=0)
            leave = int(best.argmax())
            for i in range(len(run) - 1, -1, -1):
                enter = int(back[i][leave])
                out.append((name, run[i][0], enter, leave, i + 1 < len(run)))
                leave = enter
            if len(out) >= 10_000:
                yield ends(out)
                out = []
        if out:
            yield ends(out)

    def ends(out: list[tuple]) -> pa.RecordBatch:
        names, numbers, enter, leave, on = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(names, id_type), pa.array(numbers, pa.int64()), pa.array(enter, pa.int32()), pa.array(leave, pa.int32()), pa.array(on)],
            names=["conv", "chunk", "enter", "leave", "goes_on"],
        )

    along = matrices.repartition("conv").sortWithinPartitions("conv", "chunk")
    edges = cut_lineage(along.mapInArrow(join, f"conv {kind}, chunk bigint, enter int, leave int, goes_on boolean"))
    named = edges.select(F.col("conv").alias("_conv"), F.col("chunk").alias("_chunk"), "enter", "leave", "goes_on")
    known = rows.join(named, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk")))
    known = known.select("conv", "chunk", "enter", "leave", "goes_on", "position", "text")
    known = known.repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "position", "text")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        out: list[tuple] = []
        for (name, number, enter, leave, on), run in _runs(batches, 5):
            found = [x for _, body in run for x in lines_of(body)]
            states = viterbi(np.array([symbol(x) for x in found], dtype=np.int64), own, None if enter < 0 else enter, leave)
            turns: list[tuple] = []
            for line, state in zip(found, states.tolist(), strict=True):
                if state < len(ROLES):
                    turns.append((True, ROLES[state], [line.said if line.marker == state else line.text]))
                elif turns:
                    turns[-1][2].append("\n" + line.text if line.after_blank else line.text)
                else:
                    turns.append((False, ROLES[state - len(ROLES)], ["\n" + line.text if line.after_blank else line.text]))
            for i, (begins, role, parts) in enumerate(turns):
                # A marker on a line of its own is not a line of the turn.
                body = parts[1:] if begins and len(parts) > 1 and parts[0] == "" else parts
                open_end = on and i + 1 == len(turns)
                out.append((name, number, i, begins, open_end or not begins, role, "\n".join(body)))
            if len(out) >= 1_000:
                yield fragments(out)
                out = []
        if out:
            yield fragments(out)

    def fragments(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        kinds = [id_type, pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["conv", "chunk", "at", "begins", "open", "role", "text"]
        )

    parts = cut_lineage(
        known.mapInArrow(decode, f"conv {kind}, chunk bigint, at int, begins boolean, open boolean, role string, text string")
    )
    # Turns are numbered along a transcript by the beginnings in earlier chunks: one row per chunk.
    begun = parts.groupBy("conv", "chunk").agg(F.sum(F.col("begins").cast("bigint")).alias("n"), F.min(F.col("begins")).alias("whole"))
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = begun.select(
        F.col("conv").alias("_conv"), F.col("chunk").alias("_chunk"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"), "whole"
    )
    numbered = parts.join(base, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk"))).withColumn(
        "turn", F.col("base") + F.col("at") - F.when(F.col("whole"), F.lit(0)).otherwise(F.lit(1))
    )
    whole = numbered.where(~F.col("open")).select("conv", "turn", "role", "text")
    # Only turns at a chunk's end may go on in the next one.
    pieced = numbered.where("open").groupBy("conv", "turn").agg(
        F.first("role").alias("role"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "text"))), lambda p: p["text"]), "\n").alias("text"),
    )
    turns = whole.unionByName(pieced)
    return turns.withColumn("rendered", rendered(F.col("role"), F.col("text")))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n<|end|>"))


def raw_pieces(conversations: DataFrame) -> DataFrame:
    """(conv, position, text, role): each turn as it would stand in a raw transcript.

    Speakers are marked in one of five styles, the same one throughout a conversation; one in
    eight later turns is not marked at all. Turns begin after a blank line.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(5))
    bare = (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(8)) == 0) & (F.col("turn") > 0) | ~F.coalesce(F.col("role").isin(*ROLES), F.lit(False))
    title = F.initcap("role")
    short = F.when(F.col("role") == "user", "Q").when(F.col("role") == "assistant", "A").otherwise("Context")
    other = F.when(F.col("role") == "user", "Human").when(F.col("role") == "assistant", "AI").otherwise("System")
    marker = (
        F.when(bare, F.lit(""))
        .when(style == 0, F.concat(title, F.lit(": ")))
        .when(style == 1, F.concat(F.lit("### "), title, F.lit("\n")))
        .when(style == 2, F.concat(F.lit("<|"), F.col("role"), F.lit("|>")))
        .when(style == 3, F.concat(short, F.lit(": ")))
        .otherwise(F.concat(F.lit("**"), other, F.lit(":** ")))
    )
    lead = F.when(F.col("turn") == 0, F.lit("")).otherwise(F.lit("\n"))
    return conversations.select(
        F.col("conv_id").alias("conv"), F.col("turn").alias("position"),
        F.concat(lead, marker, F.coalesce("text", F.lit("")), F.lit("\n")).alias("text"), "role",
    )
