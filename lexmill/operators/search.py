"""Filtered listings and pages."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def search_words(
    words: DataFrame, meanings: DataFrame, q: str | None = None, status: int | None = None,
    quality: str | None = None, type_: int | None = None, pos: int | None = None,
) -> DataFrame:
    """Words that pass all given filters.

    `q` is a substring, ignoring case; % and _ in it keep their LIKE meaning. Sort and cut the
    result with `keyset_page`, then count with `add_meaning_count`.
    """
    if q:
        words = words.where(F.col("form").ilike(f"%{q}%"))
    if status is not None:
        words = words.where(F.col("status") == status)
    if quality:
        words = words.where(F.col("quality_flag") == quality)
    if type_ is not None:
        words = words.where(F.col("type") == type_)
    if pos is not None:
        having = meanings.where(F.col("pos") == pos).select("word_id").distinct()
        words = words.join(having, "word_id", "left_semi")
    return words


# --- substrings by index ----------------------------------------------------

GRAM = 3
# Tasks that write an index: so many at least, and more for large tables, so that a task's grams fit its memory.
LEAST_WRITERS, TEXTS_PER_WRITER = 8, 500_000


def trigrams(rows: DataFrame, key: str = "word_id", text: str = "form") -> DataFrame:
    """(gram, at, key): every three characters in a row of the lower-cased text and where they stand; NULL has none."""
    low = F.lower(F.col(text))
    starts = F.when(F.length(low) >= GRAM, F.sequence(F.lit(1), F.length(low) - (GRAM - 1)))
    placed = rows.select(F.col(key).alias("key"), low.alias("_low"), F.explode_outer(starts).alias("at")).where("at IS NOT NULL")
    return placed.select(F.substring("_low", F.col("at"), F.lit(GRAM)).alias("gram"), "at", "key")


class TrigramIndex:
    """A positional trigram table in a folder of the caller's, with one directory for each bucket of grams.

    A search opens the buckets of its own grams only. `buckets` must be the same each time.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _bucket(self, gram: Column) -> Column:
        return F.pmod(F.xxhash64(gram), F.lit(self.buckets)).cast("int")

    def write(self, rows: DataFrame, key: str = "word_id", text: str = "form") -> None:
        # Texts are dealt out before they are cut up, as a text is smaller than its grams; each task then
        # sorts its own into all buckets, so a frequent gram's rows lie in several files of its bucket.
        texts = rows.select(key, text)
        writers = max(LEAST_WRITERS, -(-texts.count() // TEXTS_PER_WRITER))
        grams = trigrams(texts.repartition(writers, key), key, text).withColumn("bucket", self._bucket(F.col("gram")))
        grams.sortWithinPartitions("bucket", "gram").write.partitionBy("bucket").parquet(self.path)

    def postings(self, grams: list[str]) -> DataFrame:
        """(gram, at, key) of these grams."""
        asked = self.spark.createDataFrame([(g,) for g in grams], "gram string").select(self._bucket(F.col("gram")).alias("b"))
        buckets = sorted({r["b"] for r in asked.collect()})
        return self.spark.read.parquet(self.path).where(F.col("bucket").isin(*buckets) & F.col("gram").isin(*grams)).select("gram", "at", "key")

    def candidates(self, q: str) -> DataFrame | None:
        """(key) of rows that hold each piece of the pattern as a whole; None if no piece has three characters.

        % and _ part the pattern into pieces. The grams of a piece must stand one after the other.
        """
        if "\\" in q:
            return None
        pieces = [p for p in re.split("[%_]+", q) if len(p) >= GRAM]
        low = [r["p"] for r in self.spark.createDataFrame([(i, p) for i, p in enumerate(pieces)], "i int, p string").select("i", F.lower("p").alias("p")).orderBy("i").collect()]
        wanted = [(i, at, p[at : at + GRAM]) for i, p in enumerate(low) for at in range(len(p) - GRAM + 1)]
        if not wanted:
            return None
        asked = self.spark.createDataFrame(wanted, "piece int, offset int, gram string")
        met = self.postings(sorted({g for _, _, g in wanted})).join(F.broadcast(asked), "gram")
        whole = met.groupBy("key", "piece", (F.col("at") - F.col("offset")).alias("start")).agg(F.count(F.lit(1)).alias("n"))
        sizes = self.spark.createDataFrame([(i, len(p) - GRAM + 1) for i, p in enumerate(low)], "piece int, size long")
        held = whole.join(F.broadcast(sizes), "piece").where("n = size").groupBy("key").agg(F.count_distinct("piece").alias("pieces"))
        return held.where(F.col("pieces") == len(low)).select("key")


def search_substring(words: DataFrame, index: TrigramIndex, q: str, key: str = "word_id", text: str = "form") -> DataFrame:
    """The words whose text holds `q`, ignoring case, as `search_words` finds them: candidates first, then the pattern.

    A pattern without three characters in a row, or with a backslash, has no candidates by
    index; all words are then looked at.
    """
    found = index.candidates(q)
    some = words if found is None else words.join(found.withColumnRenamed("key", key), key, "left_semi")
    return some.where(F.col(text).ilike(f"%{q}%"))


# --- listings ---------------------------------------------------------------


def add_meaning_count(words: DataFrame, meanings: DataFrame) -> DataFrame:
    """`words` with their number of meanings; only those words' meanings are counted.

    For a page, cut the words first: the meanings are then filtered by a handful of ids.
    """
    mine = meanings.select("word_id").join(words.select("word_id"), "word_id", "left_semi")
    counts = mine.groupBy("word_id").agg(F.count(F.lit(1)).alias("_n"))
    return words.join(counts, "word_id", "left").withColumn("meaning_count", F.coalesce("_n", F.lit(0))).drop("_n")


def top_n(rows: DataFrame, order: list[Column], n: int, most: int) -> DataFrame:
    """The first n rows, never more than `most`; each task keeps only its own first n."""
    if not 1 <= n <= most:
        raise ValueError(f"limit must be 1..{most}")
    return rows.orderBy(*order).limit(n)


def keyset_page(
    rows: DataFrame, stamp: str, key: str, limit: int, after: tuple | None = None, most: int = 200
) -> DataFrame:
    """The page after (stamp, key), newest first, with one row more than `limit` if there is more.

    The cursor is spelled with OR and AND, which reaches the Parquet scan; a comparison of
    structs would not.
    """
    if after is not None:
        at, last = F.lit(after[0]).cast(rows.schema[stamp].dataType), F.lit(after[1])
        rows = rows.where((F.col(stamp) < at) | ((F.col(stamp) == at) & (F.col(key) < last)))
    return top_n(rows, [F.col(stamp).desc(), F.col(key).desc()], limit + 1, most + 1)


def search_audit(
    audit: DataFrame, editors: DataFrame, word_id: int | None = None, editor_id: int | None = None,
    since: Column | None = None, until: Column | None = None,
) -> DataFrame:
    """Audit rows with the editor's name; both ends of the time range count."""
    if word_id is not None:
        audit = audit.where(F.col("word_id") == word_id)
    if editor_id is not None:
        audit = audit.where(F.col("editor_id") == editor_id)
    if since is not None:
        audit = audit.where(F.col("created_at") >= since)
    if until is not None:
        audit = audit.where(F.col("created_at") <= until)
    return audit_with_editor(audit, editors)


def audit_with_editor(audit: DataFrame, editors: DataFrame) -> DataFrame:
    """Each audit row with its editor's name. Spark broadcasts the editors when they are few."""
    names = editors.select(F.col("id").alias("editor_id"), F.col("display_name").alias("editor_display_name"))
    return audit.join(names, "editor_id")
