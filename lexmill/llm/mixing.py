"""Mix sources to target weights by nested hash thresholds, without a sort of the documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.skew import free_names
from lexmill.operators.numbering import number_rows
from lexmill.session import cut_lineage

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_COPIES = 2

# A document's slot has 60 bits; each of five levels of histograms refines 12 of them.
SLOT_BITS = 60
LEVEL_BITS = 12


def word_count(text: Column) -> Column:
    """Number of words of a text; NULL and blank texts have none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN)).cast("bigint")


def slot_of(key: Column) -> Column:
    """A document's place between 0 and 2^60, the same in every run: the head of its key's MD5."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, SLOT_BITS // 4), 16, 10).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES
) -> DataFrame:
    """(source, source_size, target) of `sizes` (source, size): one row per source.

    Sources in code point order, NULL last, take the weights in turn. Targets share `share` of
    all sizes; none exceeds `max_copies` times its source, and what is above is shared again.
    Each round of that reads one aggregate row; the targets of all sources stay distributed.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = number_rows(totals, [F.col("source").asc_nulls_last()], "_place", 0)
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    weighed = cut_lineage(
        placed.select(
            "source",
            "source_size",
            pick.cast("double").alias("_weight"),
            (F.lit(max_copies) * F.col("source_size")).cast("double").alias("_most"),
        )
    )
    budget = float(weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]) * share
    full, rate = -1, 0.0
    while True:
        above = F.lit(False) if full < 0 else F.col("_most") < F.col("_weight") * F.lit(rate)
        row = weighed.agg(
            F.sum(F.when(above, F.col("_most")).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(above, 0.0).otherwise(F.col("_weight"))).alias("open"),
            F.sum(above.cast("bigint")).alias("full"),
        ).first()
        if row["full"] is None or row["full"] == full or not row["open"]:
            break
        full, rate = row["full"], (budget - row["fixed"]) / row["open"]
    target = F.least(F.col("_most"), F.col("_weight") * F.lit(rate))
    return weighed.select("source", "source_size", target.alias("target"))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, source_size, target, whole, cut): a document is taken `whole` times, once more below `cut`.

    Histograms over the slots' first bits show in which bucket a source's budget ends; only the
    documents of that bucket are looked at again, by their next bits. Hot sources are summed in
    partial aggregates, and no window holds more than 2^12 rows of a source.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    edge = targets.withColumn("whole", whole.cast("bigint")).select(
        "*", (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest"), F.lit(0).cast("bigint").alias("prefix")
    )
    levels = SLOT_BITS // LEVEL_BITS
    for level in range(levels):
        shift = SLOT_BITS - LEVEL_BITS * (level + 1)
        bucket = F.shiftright("slot", shift)
        inside = sized.select(F.col("source").alias("_source"), "size", bucket.alias("bucket"))
        line = edge.select("source", "prefix", "rest")
        if level:
            # Documents outside the bucket in which the budget ends are settled.
            match = F.col("_source").eqNullSafe(F.col("source")) & (
                F.shiftright("bucket", LEVEL_BITS) == F.col("prefix")
            )
            inside = inside.join(line.select("source", "prefix"), match, "left_semi")
        sums = inside.groupBy("_source", "bucket").agg(F.sum("size").alias("in_bucket"))
        upto = Window.partitionBy("_source").orderBy("bucket")
        sums = sums.withColumn("reached", F.sum("in_bucket").over(upto))
        found = (
            sums.join(line, F.col("_source").eqNullSafe(F.col("source")))
            .where(F.col("reached") > F.col("rest"))
            .groupBy("_source")
            .agg(F.min_by(F.struct("bucket", "in_bucket", "reached"), "bucket").alias("at"))
        )
        edge = (
            edge.join(found, F.col("source").eqNullSafe(F.col("_source")), "left")
            .select(
                "source", "source_size", "target", "whole",
                (F.col("rest") - F.coalesce(F.col("at.reached") - F.col("at.in_bucket"), F.lit(0))).alias("rest"),
                F.coalesce("at.bucket", F.shiftleft("prefix", LEVEL_BITS)).alias("prefix"),
                F.coalesce("at.in_bucket", F.lit(0)).alias("in_bucket"),
            )
        )
        edge = cut_lineage(edge)
    # The last bucket holds one slot; its documents go in if that brings the source nearer.
    nearer = (F.col("in_bucket") > 0) & (F.col("rest") * 2 >= F.col("in_bucket"))
    return edge.select(
        "source", "source_size", "target", "whole", (F.col("prefix") + nearer.cast("bigint")).alias("cut")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    max_copies: int = MAX_COPIES,
) -> DataFrame:
    """How often the mix takes each document: (doc_id, size, source_size, target, copies, taken).

    Size is the number of words, 0 for NULL. A source's target is met up to half of the document
    at its threshold. Repeated ids share a slot and are taken together; a NULL id is a key like
    any other, a NULL source one more source. Sources without words have target 0. An empty
    table gives an empty result. Columns other than the three named are not looked at.
    """
    sized = cut_lineage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            slot_of(F.col(id_col)).alias("slot"),
        )
    )
    lines = thresholds(sized, source_targets(sized, weights, share, max_copies)).withColumnRenamed("source", "_line")
    copies = F.col("whole") + (F.col("slot") < F.col("cut")).cast("bigint")
    return (
        sized.join(lines, F.col("source").eqNullSafe(F.col("_line")))
        .withColumn("copies", F.least(copies, F.lit(max_copies)))
        .select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The mix itself: every row of `docs` as often as `mix` takes it, with all its columns.

    The thresholds, one row per source, are joined; the documents are neither sorted nor joined
    with each other.
    """
    line, whole, cut, copy = free_names(docs, "_line", "_whole", "_cut", "_copy")
    sized = cut_lineage(
        docs.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), slot_of(F.col(id_col)).alias("slot"))
    )
    lines = thresholds(sized, source_targets(sized, **options)).select(
        F.col("source").alias(line), F.col("whole").alias(whole), F.col("cut").alias(cut)
    )
    copies = F.col(whole) + (slot_of(F.col(id_col)) < F.col(cut)).cast("bigint")
    times = F.least(copies, F.lit(options.get("max_copies", MAX_COPIES))).cast("int")
    return (
        docs.join(lines, F.col(source_col).eqNullSafe(F.col(line)))
        .withColumn(copy, F.explode(F.array_repeat(F.lit(1), times)))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
