"""Licence notices found by a positional index over rare words, in Spark's own expressions only."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Template(NamedTuple):
    """A notice's usual wording and the key phrase in it without which it does not count."""

    label: str
    wording: str
    key: str
    base: bool = False


TEMPLATES = (
    Template("mit", "released under the mit license", "under the mit license", True),
    Template("apache-2", "licensed under the apache license version 2 0", "apache license version 2", True),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc", True),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl-2", "this work is licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and or distribute this software"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("all-rights-reserved", "all rights reserved", "all rights reserved"),
)


def words_of(text: Column) -> Column:
    """The words of a text with A-Z lower-cased; NULL has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD_PATTERN), F.lit(0))


def document_frequencies(words: DataFrame, templates: Sequence[Template]) -> dict[str, int]:
    """In how many documents each word of the templates' key phrases stands: at most that many rows."""
    vocabulary = sorted({w for t in templates for w in t.key.split()})
    listed = F.array(*[F.lit(w) for w in vocabulary])
    found = words.select(F.explode(F.array_intersect("words", listed)).alias("word"))
    counts = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {w: counts.get(w, 0) for w in vocabulary}


def postings(templates: Sequence[Template], frequency: dict[str, int]) -> tuple[list[str], Column]:
    """The rarest word of each key phrase, and a map from it to what must stand around it.

    IDF falls as the document frequency rises, so the rarest words are those of highest IDF.
    A posting has the word's offset in the phrase, the second rarest word and its distance.
    """
    by_word: dict[str, list[Column]] = {}
    for t in templates:
        key, wording = t.key.split(), t.wording.split()
        ranked = sorted(range(len(key)), key=lambda i: (frequency[key[i]], key[i], i))
        first, second = ranked[0], ranked[min(1, len(key) - 1)]
        at = next(i for i in range(len(wording)) if wording[i : i + len(key)] == key)
        by_word.setdefault(key[first], []).append(
            F.struct(
                F.lit(t.label).alias("label"),
                F.lit(t.base).alias("base"),
                F.lit(first).alias("offset"),
                F.lit(second - first).alias("distance"),
                F.lit(key[second]).alias("other"),
                F.array(*[F.lit(w) for w in key]).alias("key"),
                F.lit(at).alias("lead"),
                F.array(*[F.lit(w) for w in wording]).alias("wording"),
            )
        )
    pairs = [c for w, items in sorted(by_word.items()) for c in (F.lit(w), F.array(*items))]
    return sorted(by_word), F.create_map(*pairs)


def _places(words: Column, anchors: list[str], index: Column) -> Column:
    def at_word(i: Column) -> Column:
        def stands(p: Column) -> Column:
            start = i - p["offset"]
            return (
                (F.get(words, i + p["distance"]) == p["other"])
                & (start >= 0)
                & (F.slice(words, F.greatest(start, F.lit(0)) + 1, F.size(p["key"])) == p["key"])
            )

        def place(p: Column) -> Column:
            origin = i - p["offset"] - p["lead"]
            agree = F.filter(
                F.sequence(F.lit(0), F.size(p["wording"]) - 1),
                lambda j: F.get(words, origin + j).eqNullSafe(F.get(p["wording"], j)),
            )
            return F.struct(
                p["label"].alias("label"),
                p["base"].alias("base"),
                (i - p["offset"]).cast("bigint").alias("start"),
                (F.size(agree).cast("double") / F.size(p["wording"])).alias("share"),
            )

        return F.transform(F.filter(F.element_at(index, F.get(words, i)), stands), place)

    listed = F.array(*[F.lit(w) for w in anchors])
    rare = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.array_contains(listed, F.get(words, i)))
    none = F.array().cast("array<struct<label:string,base:boolean,start:bigint,share:double>>")
    return F.when(F.arrays_overlap(words, listed), F.flatten(F.transform(rare, at_word))).otherwise(none)


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Sequence[Template] = TEMPLATES
) -> DataFrame:
    """Every licence notice of every text: (doc_id, n_words, places).

    `places` is an array of (label, base, start, share): the key phrase's first word, counted
    from 0, and the share of the template's wording that stands around it at the right relative
    positions. A first pass counts in how many documents the templates' words occur; a second
    looks up the rarest word of each key phrase, requires its second rarest at its distance and
    verifies the phrase. Both are narrow: only one count per template word is shuffled. A phrase
    contains its rarest word, so no notice is missed. NULL and empty texts have no words and no
    places; repeated rows repeat their result; an empty table gives none.
    """
    words = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("words"))
    anchors, index = postings(templates, document_frequencies(words, templates))
    return words.select("doc_id", F.size("words").cast("bigint").alias("n_words"), _places(F.col("words"), anchors, index).alias("places"))


def summary(scanned: DataFrame) -> DataFrame:
    """The digest columns of `scan_licenses`, one row per document.

    `n_base`, `first_word`, `last_word` and `base_labels` speak of the base templates only,
    `labels` of all; `score` is the best share, 0 without a notice.
    """
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])
    names = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0)).alias("score"),
    )
