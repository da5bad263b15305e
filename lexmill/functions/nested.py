"""Reading nested dictionary documents and model answers held as JSON text.

Documents are parsed once into a variant. Their shape is not to be trusted: every path
may hold something else, which then counts as missing.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lexmill.functions import text as T
from lexmill.functions.hashing import KEEP_NULLS

# How much of a document becomes prompt material.
MAX_REFERENCE_EXAMPLES = 10
MAX_SUMMARY_PHRASES = 10
MAX_PROMPT_MEANINGS = 5
AUDIO_BASE = "https://audio.example.com/voice?audio="

# The bucket of sentences without a sense comes after every other one.
NO_SENSE = 1_000_000_000


# --- variant access ---------------------------------------------------------


# Casts that only a value of the kind survives; none of them looks into what the value holds.
_SHALLOW = {"ARRAY": "array<variant>", "OBJECT": "struct<_:variant>"}


def has_kind(value: Column, kind: str, path: str = "$") -> Column:
    """Whether a variant, or what it has at a path, is an ARRAY, an OBJECT, a STRING or a BIGINT."""
    if kind in _SHALLOW:
        return F.try_variant_get(value, path, _SHALLOW[kind]).isNotNull()
    return F.coalesce(F.schema_of_variant(at(value, path) if path != "$" else value).startswith(kind), F.lit(False))


def at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "variant")


def items(value: Column, path: str) -> Column:
    """The elements of an array at a path; none when it is something else."""
    return F.coalesce(F.try_variant_get(value, path, "array<variant>"), F.array().cast("array<variant>"))


def text_at(value: Column, path: str = "$") -> Column:
    """A string at a path; numbers and the rest are not taken for text."""
    return T.let(at(value, path), lambda v: F.when(has_kind(v, "STRING"), v.cast("string")))


def first_word(document: Column, section: str) -> Column:
    """The section's word object, which may or may not be wrapped in a list."""
    listed, bare = f"$.{section}.word[0]", f"$.{section}.word"
    return F.when(has_kind(document, "OBJECT", listed), at(document, listed)).when(has_kind(document, "OBJECT", bare), at(document, bare))


def _flat_map(values: Column, fn: Callable[[Column], Column]) -> Column:
    return F.flatten(F.transform(values, fn))


def _translations(word: Column) -> Column:
    """All trs[*].tr[*] entries of a word object in order."""
    return _flat_map(items(word, "$.trs"), lambda group: items(group, "$.tr"))


def _texts(values: Column) -> Column:
    """The trimmed non-blank strings among variants."""
    return F.filter(F.transform(values, lambda v: T.strip(text_at(v))), lambda s: s != "")


# --- dictionary documents ---------------------------------------------------


def dictionary_summary(document: Column) -> Column:
    """Glosses, inflections, English glosses and phrases as prompt lines, cut to length."""
    entry = first_word(document, "ec")
    glosses = F.transform(
        _texts(_flat_map(_translations(entry), lambda tr: items(tr, "$.l.i"))), lambda g: F.concat(F.lit("[ec] "), g)
    )
    pairs = F.filter(
        F.transform(
            items(entry, "$.wfs"),
            lambda w: F.concat(T.blank_to_null(text_at(w, "$.wf.name")), F.lit("="), T.blank_to_null(text_at(w, "$.wf.value"))),
        ),
        lambda p: p.isNotNull(),
    )
    inflections = F.when(F.size(pairs) > 0, F.array(F.concat(F.lit("[wfs] "), F.array_join(pairs, ", "))))

    def english(tr: Column) -> Column:
        pos = F.coalesce(text_at(tr, "$.pos"), F.lit(""))
        glossed = F.transform(
            items(tr, "$.l.i"), lambda i: T.strip(F.coalesce(text_at(i), text_at(i, "$['#text']")))
        )
        return F.transform(
            F.filter(glossed, lambda g: g != ""), lambda g: T.strip(F.concat(F.lit("[ee] "), pos, F.lit(" "), g))
        )

    def phrase(wrap: Column) -> Column:
        head = T.blank_to_null(text_at(wrap, "$.phr.headword.l.i"))
        told = T.blank_to_null(text_at(wrap, "$.phr.trs[0].tr.l.i"))
        return F.concat(F.lit("[phrs] "), head, F.lit(" → "), told)

    phrases = F.transform(F.slice(items(document, "$.phrs.phrs"), 1, MAX_SUMMARY_PHRASES), phrase)
    lines = F.concat(
        glosses,
        F.coalesce(inflections, F.array().cast("array<string>")),
        _flat_map(_translations(first_word(document, "ee")), english),
        F.filter(phrases, lambda p: p.isNotNull()),
    )
    return T.truncate_text(F.array_join(lines, "\n"), "dict_summary")


def gloss_meanings(document: Column) -> Column:
    """Array of (pos, cn, en) from the listed word's gloss lines; NULL when there is none."""
    word = at(document, "$.ec.word[0]")
    lines = _flat_map(_translations(word), lambda tr: F.filter(items(tr, "$.l.i"), lambda i: has_kind(i, "STRING")))
    parsed = _flat_map(lines, lambda line: T.parse_gloss_line(text_at(line)))
    no_english = F.lit(None).cast("string")
    meanings = F.transform(parsed, lambda m: F.struct(m["pos"].alias("pos"), m["cn"].alias("cn"), no_english.alias("en")))
    return F.when(F.size(meanings) > 0, meanings)


def extract_phonetics(document: Column, audio_base: str = AUDIO_BASE) -> Column:
    """struct(phonetic_us, phonetic_uk, audio_us, audio_uk) from the first simple or else ec word."""
    simple, entry = at(document, "$.simple.word[0]"), at(document, "$.ec.word[0]")
    empty = F.coalesce(F.to_json(simple) == "{}", F.lit(True))
    word = F.when(~empty, simple).otherwise(entry)

    def sound(field: str) -> Column:
        return T.blank_to_null(text_at(word, f"$.{field}"))

    return F.struct(
        sound("usphone").alias("phonetic_us"), sound("ukphone").alias("phonetic_uk"),
        T.compose_url(audio_base, sound("usspeech")).alias("audio_us"),
        T.compose_url(audio_base, sound("ukspeech")).alias("audio_uk"),
    )


def _pairs(values: Column, english: str, chinese: str) -> Column:
    """Sentence pairs with markup removed; incomplete ones are left out."""
    cleaned = F.transform(
        values,
        lambda s: F.struct(
            T.strip_markup(text_at(s, english)).alias("en"), T.strip_markup(text_at(s, chinese)).alias("cn")
        ),
    )
    return F.filter(cleaned, lambda p: p["en"].isNotNull() & p["cn"].isNotNull())


def sense_buckets(document: Column) -> Column:
    """Array of (sense, pairs) in source order; sense is NULL where the dictionary has none."""
    def plain(tr: Column) -> Column:
        sense = F.when(has_kind(tr, "ARRAY", "$.l.i"), text_at(tr, "$.l.i[0]")).otherwise(text_at(tr, "$.l.i"))
        return F.struct(
            T.blank_to_null(sense).alias("sense"), _pairs(items(tr, "$.l.sentence"), "$.en", "$.zh").alias("pairs")
        )

    def learner(tr: Column) -> Column:
        return F.struct(
            T.strip_markup(text_at(tr, "$.tran")).alias("sense"),
            _pairs(items(tr, "$.exam_sents.sent"), "$.eng_sent", "$.chn_sent").alias("pairs"),
        )

    first = _flat_map(items(document, "$.ec.word"), lambda w: F.transform(_translations(w), plain))

    def entries(wrap: Column) -> Column:
        return F.when(has_kind(wrap, "ARRAY", "$.entries"), items(wrap, "$.entries")).otherwise(items(wrap, "$.entries.entry"))

    second = _flat_map(
        _flat_map(items(document, "$.collins.collins_entries"), entries),
        lambda e: F.transform(items(e, "$.tran_entry"), learner),
    )
    return F.filter(F.concat(first, second), lambda b: F.size(b["pairs"]) > 0)


def visit_order(document: Column) -> Column:
    """Every candidate sentence in the order in which it is considered.

    Array of (round, bucket, sense, en, cn): the first of each bucket, then the second of
    each, and so on. Sentences without a sense come last, in one bucket.
    """
    corpus = _pairs(items(document, "$.blng_sents_part['sentence-pair']"), "$.sentence", "$['sentence-translation']")
    return T.let(sense_buckets(document), lambda buckets: _visits(buckets, corpus))


def _visits(buckets: Column, corpus: Column) -> Column:
    aligned = F.filter(buckets, lambda b: b["sense"].isNotNull())
    placed = _flat_map_indexed(
        aligned,
        lambda bucket, index: F.transform(
            bucket["pairs"],
            lambda p, i: F.struct(
                i.alias("round"), index.alias("bucket"), bucket["sense"].alias("sense"), p["en"].alias("en"), p["cn"].alias("cn")
            ),
        ),
    )
    loose = F.concat(_flat_map(F.filter(buckets, lambda b: b["sense"].isNull()), lambda b: b["pairs"]), corpus)
    rest = F.transform(
        loose,
        lambda p, i: F.struct(
            (i + NO_SENSE).alias("round"), F.lit(NO_SENSE).alias("bucket"), F.lit(None).cast("string").alias("sense"),
            p["en"].alias("en"), p["cn"].alias("cn"),
        ),
    )
    return F.concat(F.array_sort(placed), rest)


def _flat_map_indexed(values: Column, fn: Callable[[Column, Column], Column]) -> Column:
    return F.flatten(F.transform(values, fn))


EXAMPLES = "array<struct<bucket:int,sense:string,en:string,cn:string>>"


def with_reference_examples(df: DataFrame, document: str, name: str = "reference_examples") -> DataFrame:
    """Add buckets (sense, examples) of at most ten sentences, picked in visit order.

    The candidates of a word are one array, so the picking is a fold inside the row, with no
    shuffle: a sentence already seen (ignoring case) uses up its turn but not the budget. The
    state never holds more than ten sentences. Each step is a projection of its own, because
    the next one refers to it more than once.
    """
    none = F.struct(F.array().cast("array<string>").alias("seen"), F.array().cast(EXAMPLES).alias("picked"))

    def take(state: Column, c: Column, key: Column) -> Column:
        entry = F.struct(c["bucket"].alias("bucket"), c["sense"].alias("sense"), c["en"].alias("en"), c["cn"].alias("cn"))
        added = F.struct(F.array_append(state["seen"], key).alias("seen"), F.array_append(state["picked"], entry).alias("picked"))
        return F.when(F.array_contains(state["seen"], key), state).otherwise(added)

    def consider(state: Column, c: Column) -> Column:
        # What comes after the tenth is not folded any more.
        full = F.size(state["picked"]) >= MAX_REFERENCE_EXAMPLES
        return F.when(full, state).otherwise(T.let(T.casefold(c["en"]), lambda key: take(state, c, key)))

    def regroup(bucket: Column) -> Column:
        mine = F.filter("_picked", lambda p: p["bucket"] == bucket)
        examples = F.transform(mine, lambda p: F.struct(p["en"].alias("en"), p["cn"].alias("cn")))
        return F.struct(F.get(mine, F.lit(0))["sense"].alias("sense"), examples.alias("examples"))

    return (
        df.withColumn("_visits", visit_order(F.col(document)))
        .withColumn("_picked", F.aggregate("_visits", none, consider, lambda s: s["picked"]))
        .withColumn(name, F.transform(F.array_sort(F.array_distinct("_picked.bucket")), regroup))
        .drop("_visits", "_picked")
    )


def top_meanings(payload: Column) -> Column:
    """The first five meanings of a payload variant as JSON; an empty list for anything else."""
    return F.to_json(F.slice(items(payload, "$.meanings"), 1, MAX_PROMPT_MEANINGS), KEEP_NULLS)


def shape_examples(answer: Column) -> Column:
    """Canonical JSON `{"per_meaning": [...]}`: a single-meaning answer is wrapped, the rest is empty."""
    single = F.concat(
        F.lit('{"per_meaning":[{"examples":'), F.to_json(at(answer, "$.examples"), KEEP_NULLS),
        F.lit(',"meaning_index":'), F.coalesce(F.to_json(at(answer, "$.meaning_index"), KEEP_NULLS), F.lit("0")), F.lit("}]}"),
    )
    return (
        F.when(has_kind(answer, "ARRAY", "$.per_meaning"), F.to_json(answer, KEEP_NULLS))
        .when(has_kind(answer, "ARRAY", "$.examples"), single)
        .otherwise(F.lit('{"per_meaning":[]}'))
    )


# --- model answers ----------------------------------------------------------

# The code fence that models put around JSON.
FENCE = r"(?s)^\s*```(?:json)?\s*(.*?)\s*```\s*$"

# A quote ends a string when a delimiter or the end of the text follows it.
_STRING = re.compile(r'"((?:\\.|[^"\\]|"(?![ \t\n\r]*(?:[,:}\]]|\Z)))*)"', re.DOTALL)
_PAIRS = {"{": "}", "[": "]"}


def _refuse(constant: str):
    raise ValueError(f"{constant} is not JSON")


def _loads(text: str):
    try:
        return json.loads(text, parse_constant=_refuse)
    except (ValueError, RecursionError):
        return None


def _closings(text: str) -> dict[int, int]:
    """Where each bracket that is closed ends, counting only brackets of its own kind; one pass."""
    open_at: dict[str, list[int]] = {right: [] for right in _PAIRS.values()}
    ends = {}
    for m in re.finditer(r"[{}\[\]]", text):
        if m[0] in _PAIRS:
            open_at[_PAIRS[m[0]]].append(m.start())
        elif open_at[m[0]]:
            ends[open_at[m[0]].pop()] = m.end()
    return ends


def _quotes_escaped(text: str) -> str:
    return _STRING.sub(lambda m: '"' + re.sub(r'(\\.)|"', lambda q: q[1] or '\\"', m[1], flags=re.DOTALL) + '"', text)


def repair_json(text: str) -> tuple[str, str] | None:
    """(JSON, method) of the first bracketed piece that parses as it is or with inner quotes escaped."""
    for start, end in sorted(_closings(text).items()):
        piece = text[start:end]
        for method, candidate in (("extracted", piece), ("repaired", _quotes_escaped(piece))):
            value = _loads(candidate)
            if value is not None:
                return json.dumps(value, ensure_ascii=False), method
    return None


@F.pandas_udf(StructType([StructField("json", StringType()), StructField("method", StringType())]))
def _repair(texts: pd.Series) -> pd.DataFrame:
    found = [(None if t is None else repair_json(t)) or (None, None) for t in texts]
    return pd.DataFrame(found, columns=["json", "method"])


def parse_model_json(df: DataFrame, text: str, parsed: str = "parsed") -> DataFrame:
    """Add `parsed` (variant), `method` and `error` for model answers in a text column.

    Plain and fenced JSON is parsed natively. Python sees only the texts that failed: it gets
    NULL for all others, and one Arrow batch at a time.
    """
    stripped = T.strip(F.col(text))
    fenced = T.strip(F.regexp_extract(stripped, FENCE, 1))
    inner = F.when(fenced != "", fenced).otherwise(stripped)
    native = df.withColumn("_inner", inner).withColumn("_native", F.try_parse_json("_inner"))
    fixed = native.withColumn("_fixed", _repair(F.when(F.col("_native").isNull(), F.col("_inner"))))
    answer = F.coalesce("_native", F.try_parse_json("_fixed.json"))
    failed = answer.isNull()
    return (
        fixed.withColumn(parsed, answer)
        .withColumn(
            "method",
            F.when(F.col("_native").isNull(), F.when(F.col(parsed).isNotNull(), F.col("_fixed.method")))
            .when(F.col("_inner") == T.strip(F.col(text)), "plain").otherwise("fenced"),
        )
        .withColumn("error", F.when(failed, F.concat(F.lit("could not parse JSON: "), T.truncate_text(F.col(text), "parse_error"))))
        .drop("_inner", "_native", "_fixed")
    )
