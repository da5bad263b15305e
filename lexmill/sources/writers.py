"""Sinks: growing ledgers, JSON-lines logs, and tables published as whole snapshots."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.hashing import to_json


def append_ledger(rows: DataFrame, path: str, at: str = "started_at") -> None:
    """Append rows to a ledger that is partitioned by the date of `at`."""
    rows.withColumn("date", F.to_date(at)).write.mode("append").partitionBy("date").parquet(path)


def append_json_log(records: DataFrame, path: str) -> None:
    """Append one JSON object per record; nulls are written."""
    records.write.mode("append").option("ignoreNullFields", "false").json(path)


def append_run_report(report: DataFrame, path: str) -> None:
    """One summary line per table and run. The report is as long as the list of tables."""
    append_json_log(report.coalesce(1), path)


class Snapshots:
    """Tables published together as new directories under one root.

    A publication writes every table to its own new directory under the root and then appends one row to the
    `published` list. Readers follow the newest row, so they see all tables of one
    publication or all of another, and a job that dies leaves the old ones in place.
    """

    POINTER = "published_at timestamp, tables map<string,string>"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def stage(self, tables: dict[str, DataFrame]) -> dict[str, str]:
        """Write the tables where no reader looks yet; returns their paths."""
        paths = {}
        for name, df in tables.items():
            paths[name] = f"{self.root}/tables/{name}-{uuid.uuid4().hex}"
            df.write.option("compression", "zstd").parquet(paths[name])
        return paths

    def publish(self, paths: dict[str, str]) -> None:
        row = self.spark.range(1).select(
            F.current_timestamp().alias("published_at"),
            F.create_map(*[F.lit(x) for pair in paths.items() for x in pair]).alias("tables"),
        )
        row.write.mode("append").json(f"{self.root}/published")

    def current(self) -> dict[str, str]:
        """Paths of the newest publication: one small row comes to the driver."""
        listed = self.spark.read.schema(self.POINTER).json(f"{self.root}/published")
        newest = listed.orderBy(F.col("published_at").desc()).limit(1).collect()
        return dict(newest[0]["tables"])

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.current()[name])


def count_check(sides: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(table_name, source_count, target_count, same) for pairs of tables."""
    out = None
    for name, (source, target) in sides.items():
        tagged = source.select(F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(
            target.select(F.lit(0).alias("s"), F.lit(1).alias("t"))
        )
        row = tagged.agg(
            F.lit(name).alias("table_name"),
            F.coalesce(F.sum("s"), F.lit(0)).alias("source_count"),
            F.coalesce(F.sum("t"), F.lit(0)).alias("target_count"),
        )
        out = row if out is None else out.unionByName(row)
    return out.withColumn("same", F.col("source_count") == F.col("target_count"))


def mirror_refresh(
    snapshots: Snapshots, tables: dict[str, DataFrame], sources: dict[str, DataFrame], dry_run: bool = False
) -> DataFrame:
    """Stage all tables, compare them with the tables they were made from, and publish them together unless a count differs.

    `sources` names the table that each mirror table must have one row for; rows that got lost
    on the way, such as children without a parent, show up as a difference. Returns the count
    report; `published` tells whether readers now see the new tables.
    """
    spark = snapshots.spark
    paths = snapshots.stage(tables)
    staged = {name: spark.read.parquet(path) for name, path in paths.items()}
    report = count_check({name: (sources[name], staged[name]) for name in tables if name in sources})
    # One row per table comes to the driver to decide.
    rows = report.collect()
    good = all(r["same"] for r in rows) and not dry_run
    if good:
        snapshots.publish(paths)
    return spark.createDataFrame([(*r, good) for r in rows], report.schema.add("published", "boolean"))


def export_packaged_json(entries: DataFrame, path: str, limit: int | None = None) -> None:
    """(word_id, word_json) rows as gzipped JSON lines, ordered by word_id over all files."""
    ordered = entries.select("word_id", "word_json").orderBy("word_id")
    if limit is not None:
        ordered = ordered.limit(limit)
    ordered.write.option("compression", "gzip").json(path)


def write_table_jdbc(df: DataFrame, url: str, table: str, batch: int = 5000, **options: str) -> None:
    """Load a staging table of another database in batches."""
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch), truncate="true", **options).mode(
        "overwrite"
    ).save()


def json_rows(df: DataFrame, keys: Sequence[str], name: str = "json") -> DataFrame:
    """Key columns and the rest of the row as one JSON text."""
    rest: list[Column] = [F.col(c) for c in df.columns if c not in keys]
    return df.select(*keys, to_json(F.struct(*rest)).alias(name))
