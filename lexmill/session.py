"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
# Packed files up to this size hold what a driver can send to all tasks, however well they are packed.
PACKED = 1 << 19
# Spark's estimates are products of sizes for joins, and the largest long for RDDs; neither tells anything.
UNKNOWN = 1 << 50


def local_session(cpus: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lexmill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read, named by the cluster in spark.checkpoint.dir.

    Only a session in one process (local or local[n], as in tests) may go without: it gets a
    folder of its own. Anywhere else a missing setting is an error, because a machine-local
    folder dies with its machine.
    """
    configured = spark.sparkContext.getConf().get(CHECKPOINT_KEY) or spark.conf.get(CHECKPOINT_KEY, None)
    if not configured:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"{CHECKPOINT_KEY} must name a shared folder")
        configured = tempfile.mkdtemp(prefix="lexmill-")
        spark.conf.set(CHECKPOINT_KEY, configured)
    return configured


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses.

    Everything of one application lies in one folder, which can be removed when it is over.
    """
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark).rstrip('/')}/lexmill-{app}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to a table in the shared folder and read them back.

    The rows survive the loss of executors, and later plans start from a Parquet scan, which
    prunes columns and takes filters. Nobody else reads the table, so it is packed tightly:
    prompts and documents, which repeat much, take a fraction of the space.
    """
    path = fresh_path(df.sparkSession, "cut")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_rows(df: DataFrame) -> DataFrame:
    """`df` as the side of a join that Spark may otherwise send to all tasks, by way of the driver.

    Spark judges a table by the size of its files. Ids in order and texts that repeat are packed to a hundredth,
    so files that look small can hold more rows than a driver has room for. A side whose files
    exceed PACKED is matched by a shuffle; a smaller one, and one whose size is only known when it runs, is left to Spark.
    """
    size = int(str(df._jdf.queryExecution().analyzed().stats().sizeInBytes()))
    return df.hint("merge") if PACKED < size < UNKNOWN else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out to all cores when their files make fewer tasks than there are cores.

    For heavy work per row on a small number of files. A large table has more tasks than that
    and stays as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def spread_table(table: DataFrame, *keys: str) -> DataFrame:
    """As `spread`, for a table just read, of whose tasks only those count that get rows.

    A file is cut into as many pieces as its size asks for, but a row group is read by one task
    alone: a large file with few row groups leaves the other tasks empty. The count of
    filled tasks reads no column.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    if table.rdd.getNumPartitions() >= cores and table.select(F.spark_partition_id()).distinct().count() >= cores:
        return table
    return table.repartition(cores, *keys)
