"""Quality rules: repetition within a document, and lines that many documents of a host share.

Spark's own expressions only. A text is split once; what is shuffled are hashes and counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.skew import free_names, look_up
from lexmill.session import cut_lineage

BLANKS = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]"
IGNORED = "[\\x20\\x09-\\x0D0-9]+"
NO_SYMBOL = "[^#*$%&|<>]+"
WINDOW = 5

# A document with fewer words fails, and one of whose words more than this percentage repeats.
LEAST_WORDS = 10
MOST_REPEATED = 20
# A line goes if it stands in more than so many different texts of its host.
MOST_TEXTS = 20
# A document goes if less than this percentage of its lines' characters remains.
LEAST_LEFT = 30


def normal_line(line: Column) -> Column:
    """A line as it is compared: lower-cased, without blanks and digits."""
    return F.regexp_replace(F.lower(line), F.lit(IGNORED), F.lit(""))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(WORD)))


def _window_keys(words: Column) -> Column:
    """A 64-bit hash of every run of WINDOW words; two different runs share one with a chance of about 2^-64."""
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashed = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    return F.when(F.size(words) >= WINDOW, hashed).otherwise(F.array().cast("array<bigint>"))


def _covered(starts: Column) -> Column:
    """How many words the windows at these ascending starts cover."""
    added = F.transform(starts, lambda at, j: F.when(j == 0, WINDOW).otherwise(F.least(F.lit(WINDOW), at - F.get(starts, j - 1))))
    return F.aggregate(added, F.lit(0).cast("bigint"), lambda a, b: a + b)


def measured(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """One row per document: counts, host, the text's 128-bit key, and (hash, characters) of every line with a word.

    No shuffle. Columns that later ones use twice or more stay projections of their own, so each
    is computed once.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{host_col}`").alias("host"), text.alias("text"))
    split = rows.select("id", "host", "text", _words(F.col("text")).alias("words"), _lines(F.col("text")).alias("lines"))
    keyed = split.select("*", _window_keys(F.col("words")).alias("keys"))
    # Most texts repeat no window: a hash set tells, and only the others are sorted.
    repeats = F.size(F.array_distinct("keys")) < F.size("keys")
    seats = F.sort_array(F.transform("keys", lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    sorted_ = keyed.select("*", F.when(repeats, seats).alias("seats"))
    twice = F.filter("seats", lambda x, j: (F.get("seats", j - 1)["k"] == x["k"]) | (F.get("seats", j + 1)["k"] == x["k"]))
    starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
    found = sorted_.select("*", F.when(F.col("seats").isNotNull(), starts).alias("starts"))
    return found.select(
        "id",
        "host",
        F.xxhash64("text").alias("key_a"),
        F.xxhash64(F.lit(1), "text").alias("key_b"),
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("text", F.lit(NO_SYMBOL), F.lit(""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.col("starts").isNotNull(), _covered(F.col("starts"))).otherwise(F.lit(0).cast("bigint")).alias("n_repeat_words"),
        F.transform(
            "lines",
            lambda line: F.struct(F.xxhash64(normal_line(line)).alias("line"), F.length(line).alias("chars")),
        ).alias("lines"),
    )


def _texts(measures: DataFrame) -> DataFrame:
    """(host, key_a, key_b, copies, lines): equal texts of a host are one row with a count."""
    return measures.groupBy("host", "key_a", "key_b").agg(F.count(F.lit(1)).alias("copies"), F.first("lines").alias("lines"))


def frequent_lines(texts: DataFrame, most: int = MOST_TEXTS) -> DataFrame:
    """(host, line, n_texts): hashes of normalised lines that stand in more than `most` texts of a host."""
    hashes = F.array_distinct(F.transform("lines", lambda x: x["line"]))
    lines = texts.select("host", F.explode_outer(hashes).alias("line")).where("line IS NOT NULL")
    return lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_texts")).where(F.col("n_texts") > most)


def _lost(texts: DataFrame, frequent: DataFrame) -> DataFrame:
    """(host, key_a, key_b, copies, lost, gone): for texts with frequent lines those lines' characters and hashes."""
    lines = texts.select("host", "key_a", "key_b", "copies", F.explode_outer("lines").alias("at")).select(
        "host", "key_a", "key_b", "copies", F.col("at.line").alias("line"), F.col("at.chars").alias("chars")
    )
    total = frequent.agg(F.coalesce(F.sum("n_texts"), F.lit(0))).first()[0]
    met = look_up(lines, frequent.withColumn("met", F.lit(True)), ["host", "line"], "n_texts", total).where("met")
    return met.groupBy("host", "key_a", "key_b").agg(
        F.first("copies").alias("copies"), F.sum("chars").cast("bigint").alias("lost"), F.collect_set("line").alias("gone")
    )


def _judged(docs: DataFrame, id_col: str, text_col: str, host_col: str, most: int) -> tuple[DataFrame, DataFrame]:
    """(measures, lost), both written."""
    measures = cut_lineage(measured(docs, id_col, text_col, host_col))
    texts = cut_lineage(_texts(measures.select("host", "key_a", "key_b", "lines")))
    return measures, cut_lineage(_lost(texts, cut_lineage(frequent_lines(texts, most))))


def _base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _depleted(chars: Column, lost: Column, least_left: int) -> Column:
    return 100 * (chars - lost) < least_left * chars


def _line_chars() -> Column:
    return F.aggregate("lines", F.lit(0).cast("bigint"), lambda a, x: a + x["chars"])


def judge_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    most: int = MOST_TEXTS,
    least_left: int = LEAST_LEFT,
) -> DataFrame:
    """One row per document: (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lost_chars, kept).

    Lines of a host are normalised, hashed and counted once per different text; lines above
    `most` texts are taken out of all texts of the host (`n_lost_chars`), and a document of which
    too little remains is not kept, nor is one that fails the base rules. Equal texts of a host
    count as one: copies are no sign of a boilerplate line, and counting them would lose a text
    with all its copies. What is shuffled has the size of the lines' hashes; very common lines
    and very often copied texts are looked up by broadcast, at most HOT_KEYS of each.

    NULL and empty texts have no words and fail. A NULL host is one more host; NULL and repeated
    ids are rows of their own, and repeated rows repeat their result. An empty table gives none.
    Other columns are not looked at.
    """
    measures, lost = _judged(docs, id_col, text_col, host_col, most)
    rows = measures.withColumn("chars", _line_chars()).drop("lines")
    joined = look_up(rows, lost.drop("gone"), ["host", "key_a", "key_b"], "copies", rows.count())
    return joined.withColumn("lost", F.coalesce("lost", F.lit(0).cast("bigint"))).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        _base_failed().alias("base_failed"),
        F.col("lost").alias("n_lost_chars"),
        (~_base_failed() & ~_depleted(F.col("chars"), F.col("lost"), least_left)).alias("kept"),
    )


def clean_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    most: int = MOST_TEXTS,
    least_left: int = LEAST_LEFT,
) -> DataFrame:
    """The rows that `judge_documents` keeps, with all columns of `docs`; frequent lines are taken out of the text.

    A text without such lines stays as it is; in others the remaining lines, empty ones included,
    are joined again. Only here are texts shuffled, those of hot groups not by their key.
    """
    key_a, key_b, gone, bad = free_names(docs, "_key_a", "_key_b", "_gone", "_bad")
    measures, lost = _judged(docs, id_col, text_col, host_col, most)
    keys = ["host", "key_a", "key_b"]
    sizes = measures.select(*keys, _base_failed().alias("bad"), _line_chars().alias("chars"))
    sizes = sizes.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"), F.first("bad").alias("bad"), F.first("chars").alias("chars"))
    judged = look_up(sizes, lost, keys, "copies", measures.count())
    judged = judged.withColumn("bad", F.col("bad") | F.coalesce(_depleted(F.col("chars"), F.col("lost"), least_left), F.lit(False)))
    table = judged.where("bad OR gone IS NOT NULL").select(
        F.col("host").alias(host_col), F.col("key_a").alias(key_a), F.col("key_b").alias(key_b), "copies", F.col("gone").alias(gone), F.col("bad").alias(bad)
    )
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    keyed = docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.xxhash64(text).alias(key_a), F.xxhash64(F.lit(1), text).alias(key_b))
    joined = look_up(keyed, table, [host_col, key_a, key_b], "copies", measures.count())
    rest = F.filter(
        F.split(text, "\n"),
        lambda line: ~(F.rlike(line, F.lit(WORD)) & F.array_contains(F.col(gone), F.xxhash64(normal_line(line)))),
    )
    cleaned = F.when(F.col(gone).isNotNull(), F.array_join(rest, "\n")).otherwise(F.col(f"`{text_col}`"))
    stays = joined.where(~F.coalesce(F.col(bad), F.lit(False)))
    return stays.select(*[(cleaned.alias(c) if c == text_col else F.col(f"`{c}`")) for c in docs.columns])
