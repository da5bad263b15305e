"""Flat tables for a second database, and proof that both sides agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.hashing import digest_sum, digest_xor, row_digest, to_json
from lexmill.operators.documents import collect_child_ids, sentences_with_word
from lexmill.operators.nesting import PART_SIZE
from lexmill.operators.numbering import HOT_FLOOR
from lexmill.session import cut_lineage

# Columns that the mirror keeps but always leaves empty.
EMPTY_WORD_COLUMNS = (
    "plural", "structure", "third_person", "present_participle", "past_tense", "past_participle", "base",
    "comparative", "superlative", "derivatives", "morpheme_derivatives", "family",
)
# The key columns that a table's digest covers.
DIGEST_COLUMNS = {
    "word": ("word_id", "form", "type", "source"),
    "meaning": ("meaning_id", "word_id", "pos", "cn_paraphrase"),
    "sentence": ("sentence_id", "word_id", "form"),
    "mnemonic": ("mnemonic_id", "word_id", "type"),
    "phrase": ("phrase_id", "form"),
}


def _empty(name: str) -> Column:
    return F.lit(None).cast("string").alias(name)


def _or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    return (F.col(name) if name in df.columns else F.lit(None).cast(kind)).alias(name)


def list_json(df: DataFrame, name: str) -> Column:
    """A list column as JSON without blanks; empty or absent is NULL."""
    if name not in df.columns:
        return _empty(name)
    return F.when(F.size(name) > 0, F.to_json(name)).alias(name)


def _ids(children: DataFrame, parent: str, child: str, name: str, key: str = "id", order: Sequence | None = None, floor: int = HOT_FLOOR) -> DataFrame:
    """(parent, name): the first part of the child list; further parts are rows of `mirror_overflow`."""
    return collect_child_ids(children, parent, child, key, order, floor=floor).where("part_no = 0").select(
        parent, F.col("ids").alias(name)
    )


def mirror_overflow(children: DataFrame, kind: str, parent: str, child: str, key: str = "id", order: Sequence | None = None, floor: int = HOT_FLOOR) -> DataFrame:
    """(kind, parent_id, part_no, ids): the child lists that go on after the one in the parent's row.

    Only parents with more than PART_SIZE children are collected, and there are few of them. They are written
    first, so that Spark knows how few and does not shuffle all children to meet them.
    """
    large = cut_lineage(children.groupBy(parent).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > PART_SIZE).select(parent))
    parts = collect_child_ids(children.join(large, parent, "left_semi"), parent, child, key, order, floor=floor)
    return parts.where("part_no > 0").select(F.lit(kind).alias("kind"), F.col(parent).alias("parent_id"), "part_no", "ids")


def mirror_tables(
    words: DataFrame, meanings: DataFrame, sentences: DataFrame, mnemonics: DataFrame, phrases: DataFrame,
    content: Column, sentence_order: Sequence | None = None, floor: int = HOT_FLOOR,
) -> dict[str, DataFrame]:
    """The five flat tables, and `overflow` with the rest of oversized child lists."""
    owned = phrases.withColumnRenamed("owner_word_id", "word_id")
    overflow = (
        mirror_overflow(meanings, "meanings", "word_id", "meaning_id", floor=floor)
        .unionByName(mirror_overflow(mnemonics, "mnemonics", "word_id", "mnemonic_id", floor=floor))
        .unionByName(mirror_overflow(owned, "phrases", "word_id", "phrase_id", floor=floor))
        .unionByName(mirror_overflow(sentences, "sentences", "meaning_id", "sentence_id", "sentence_id", sentence_order, floor))
    )
    return {
        "word": mirror_words(words, meanings, mnemonics, phrases, floor),
        "meaning": mirror_meanings(meanings, sentences, sentence_order, floor),
        "sentence": mirror_sentences(sentences, meanings, floor),
        "mnemonic": mirror_mnemonics(mnemonics, content),
        "phrase": mirror_phrases(phrases),
        "overflow": overflow,
    }


def mirror_words(words: DataFrame, meanings: DataFrame, mnemonics: DataFrame, phrases: DataFrame, floor: int = HOT_FLOOR) -> DataFrame:
    owned = phrases.withColumnRenamed("owner_word_id", "word_id")
    joined = (
        words.join(_ids(meanings, "word_id", "meaning_id", "meanings", floor=floor), "word_id", "left")
        .join(_ids(mnemonics, "word_id", "mnemonic_id", "mnemonics", floor=floor), "word_id", "left")
        .join(_ids(owned, "word_id", "phrase_id", "phrases", floor=floor), "word_id", "left")
    )
    return joined.select(
        "word_id", "type", "form", F.coalesce("phonetic_us", F.lit("")).alias("phonetic_us"), _or_null(words, "audio_us"),
        F.coalesce("phonetic_uk", F.lit("")).alias("phonetic_uk"), _or_null(words, "audio_uk"), "meanings", "mnemonics", "phrases",
        *[_empty(c) for c in EMPTY_WORD_COLUMNS], "source", "status",
    )


def mirror_meanings(meanings: DataFrame, sentences: DataFrame, order: Sequence | None = None, floor: int = HOT_FLOOR) -> DataFrame:
    joined = meanings.join(_ids(sentences, "meaning_id", "sentence_id", "sentences", "sentence_id", order, floor), "meaning_id", "left")
    return joined.select(
        "meaning_id", "word_id", _empty("user_group"), "pos", F.lit(None).cast("smallint").alias("pos_sub"),
        *[list_json(meanings, c) for c in ("equivalents", "synonyms", "antonyms")],
        *[_or_null(meanings, c) for c in ("phonetic_us", "audio_us", "phonetic_uk", "audio_uk")],
        "cn_paraphrase", "en_paraphrase", "sentences", "source",
    )


def mirror_sentences(sentences: DataFrame, meanings: DataFrame, floor: int = HOT_FLOOR) -> DataFrame:
    joined = sentences_with_word(sentences, meanings, floor)
    return joined.select(
        "sentence_id", "word_id", "meaning_id", _empty("user_group"), "form", list_json(sentences, "highlight"), "translation",
        _empty("audio_us"), _empty("audio_uk"), "source", _or_null(sentences, "citation", "smallint"), _or_null(sentences, "citation_detail"),
    )


def mirror_mnemonics(mnemonics: DataFrame, content: Column) -> DataFrame:
    return mnemonics.select(
        "mnemonic_id", "word_id", "type", F.lit(0).alias("user_group"), to_json(content).alias("content"), "source", F.lit(0).alias("creator_id")
    )


def mirror_phrases(phrases: DataFrame) -> DataFrame:
    return phrases.select("phrase_id", "form", "meaning", F.lit("").alias("audio_us"), F.lit("").alias("audio_uk"))


def table_checksums(sides: dict[str, tuple[DataFrame, DataFrame]], columns: dict[str, Sequence[str]] = DIGEST_COLUMNS) -> DataFrame:
    """Per table: counts and digests of both sides, and whether they drift.

    The digests do not depend on row order. XOR alone would lose pairs of equal rows, so a sum
    goes with it. One pass per table, partially aggregated.
    """
    out = None
    for name, (source, target) in sides.items():
        cols = columns[name]

        def side(df: DataFrame, tag: str) -> DataFrame:
            return df.select(F.lit(tag).alias("side"), row_digest(*[F.col(c) for c in cols]).alias("d"))

        both = side(source, "s").unionByName(side(target, "t"))

        def of(tag: str, value: Column) -> Column:
            return F.when(F.col("side") == tag, value)

        row = both.agg(
            F.lit(name).alias("table_name"), F.count(of("s", F.col("d"))).alias("source_count"), F.count(of("t", F.col("d"))).alias("target_count"),
            digest_xor(of("s", F.col("d"))).alias("source_xor"), digest_xor(of("t", F.col("d"))).alias("target_xor"),
            digest_sum(of("s", F.col("d"))).alias("source_sum"), digest_sum(of("t", F.col("d"))).alias("target_sum"),
        )
        out = row if out is None else out.unionByName(row)
    same = (
        (F.col("source_count") == F.col("target_count")) & (F.col("source_xor") == F.col("target_xor")) & (F.col("source_sum") == F.col("target_sum"))
    )
    return out.withColumn("drift", ~same)
