"""Reading word lists, glossaries, result logs and entity tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text as T

FETCH_SIZE = 5000
GLOSSARY_ENTRIES = "array<struct<pos:string,cn:string,en:string>>"


def read_word_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, mark, piece, raw_form): one row per line of text files.

    (file, block, mark, piece) sorts lines in input order; operators that keep the first
    spelling order by it, so no pass is spent on numbering.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("mark"),
        "value",
    )
    return lines.select("file", "block", "mark", F.posexplode(F.split("value", T.LINE_BREAK)).alias("piece", "raw_form"))


LINE_ORDER = ("file", "block", "mark", "piece")


def clean_glossary(entries: Column) -> Column:
    """Usable entries: a gloss without its leading bracketed hint, English without tags."""
    # The two clean-up patterns.
    def clean(entry: Column) -> Column:
        cn = T.blank_to_null(T.strip(F.regexp_replace(entry["cn"], r"^[（(][^）)]{1,20}[）)](?U)\s*", "")))
        en = T.blank_to_null(T.strip(F.regexp_replace(entry["en"], "<[^>]+>", "")))
        return F.struct(entry["pos"].alias("pos"), cn.alias("cn"), en.alias("en"))

    return F.filter(F.transform(entries, clean), lambda e: e["cn"].isNotNull())


def _glossary_objects(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, value, entries): the JSON objects of glossary files; entries is NULL where one is corrupt.

    A file is one object, however it is laid out, or one object per line: the latter if its
    first line is an object by itself.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    lined = F.try_parse_json(F.get(F.split(F.ltrim("value"), "\n", 2), F.lit(0))).isNotNull()
    pieces = files.select("file", F.posexplode(F.when(lined, F.split("value", "\n")).otherwise(F.array("value"))).alias("at", "value"))
    entries = F.when(F.try_parse_json("value").isNotNull(), F.from_json("value", f"map<string,{GLOSSARY_ENTRIES}>"))
    return pieces.where(F.trim("value") != "").withColumn("entries", entries)


def glossary_errors(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, value): what is no JSON object in glossary files: lines, counted from 0, or a whole file."""
    return _glossary_objects(spark, path).where("entries IS NULL").drop("entries")


def read_glossary(spark: SparkSession, path: str) -> DataFrame:
    """(word, meanings) from JSON files that map words to entries; words left empty are missing.

    What cannot be read is listed by `glossary_errors`.
    """
    rows = _glossary_objects(spark, path).select(F.explode("entries").alias("word", "entries"))
    return rows.select("word", clean_glossary(F.col("entries")).alias("meanings")).where(F.size("meanings") > 0)


def read_result_log(spark: SparkSession, *paths: str) -> DataFrame:
    """Distinct word_id of earlier results: bad lines and ids that are not integers are skipped."""
    parsed = spark.read.text(list(paths)).select(F.try_parse_json("value").alias("v"))
    found = F.try_variant_get("v", "$.word_id", "variant")
    ids = parsed.where(F.schema_of_variant(found) == "BIGINT").select(
        F.try_variant_get("v", "$.word_id", "bigint").alias("word_id")
    )
    return ids.distinct()


def scan_entity_tables(
    words: DataFrame, meanings: DataFrame, sentences: DataFrame, mnemonics: DataFrame, first_words: int | None = None
) -> dict[str, DataFrame]:
    """The four tables of an export; with `first_words`, only the first words and their children."""
    if first_words is not None:
        words = words.orderBy("word_id").limit(first_words)
    ids = words.select("word_id")
    kept = meanings.join(ids, "word_id", "left_semi")
    return {
        "words": words,
        "meanings": kept,
        "sentences": sentences.join(kept.select("meaning_id"), "meaning_id", "left_semi"),
        "mnemonics": mnemonics.join(ids, "word_id", "left_semi"),
    }


def read_table_partitioned(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, partitions: int, **options: str
) -> DataFrame:
    """A database table read in parallel slices of a numeric key, in fetches of 5,000 rows."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=key, lowerBound=str(lower), upperBound=str(upper),
        numPartitions=str(partitions), fetchsize=str(FETCH_SIZE), **options,
    )
    return reader.load()
