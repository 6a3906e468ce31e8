"""Session settings, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT_BYTES = 256 * 1024 * 1024


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, driver_memory: str | None = None) -> SparkSession:
    """A session with the settings the operators rely on; an existing one is reused."""
    builder = (
        SparkSession.builder.appName("genolith")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session; raises without it."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    ) or spark.sparkContext.getCheckpointDir()
    if not path:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return path


def use_own_folder(spark: SparkSession) -> None:
    """For one-machine runs (tests, bench, the contract): a folder of the run's own, removed when it ends.

    Does nothing where the session names a folder.
    """
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        return
    try:
        shared_dir(spark)
    except ValueError:
        import tempfile

        folder = tempfile.TemporaryDirectory(prefix="genolith-", ignore_cleanup_errors=True)
        OWN_FOLDERS.append(folder)
        spark.conf.set("spark.checkpoint.dir", f"file://{folder.name}")


#: Kept until the interpreter ends, which removes them.
OWN_FOLDERS: list = []


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder and read them back.

    The written table survives lost executors, is read column by column, and
    its size is known to the planner.
    """
    path = scratch_table(df.sparkSession, "durable")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that a task writes at least, where there are fewer than it takes to keep all cores busy.
TASK_ROWS = 50_000


def in_few_tasks(df: DataFrame, rows: int, each: int = TASK_ROWS) -> DataFrame:
    """``df``, of some ``rows`` rows, in tasks of about ``each`` rows, as many as there are cores at least.

    For narrow tables: hundreds of shuffled partitions with a few rows would each cost a task and a file.
    More rows than that stay in the partitions they are in.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


def in_more_tasks(df: DataFrame, rows: int, *keys: str, each: int = TASK_ROWS) -> DataFrame:
    """``df``, of some ``rows`` rows, dealt by ``keys`` to tasks of about ``each`` rows.

    Adaptive execution joins shuffled partitions by their compressed size until there is one per core, so that what a
    task sorts and hashes would grow with the table. What fits the cores' tasks stays as it is.
    """
    tasks = -(-rows // each)
    return df if tasks <= df.sparkSession.sparkContext.defaultParallelism else df.repartition(tasks, *keys)


def scratch_table(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def row_width(schema: T.StructType) -> int:
    """Bytes one row takes in memory besides its text."""
    widths = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.BooleanType: 1, T.FloatType: 4}
    return 16 + sum(widths.get(type(f.dataType), 8) for f in schema.fields)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast when its counted size, texts measured, is below ``limit``.

    Above it the join shuffles (with adaptive skew handling): unfolded rows are far more than
    the planner takes them for, so the other side must not be broadcast on its estimate. Meant for per-sample and per-gene tables, where counting is cheap
    next to the genotype scan that follows; pass a written table where the lineage is long.
    """
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)) for f in df.schema.fields):
        return df
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    measured = sum((F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`")) + 24), F.lit(0)) for c in texts), F.lit(0))
    rows, text = df.agg(F.count(F.lit(1)), measured).first()
    return F.broadcast(df) if rows * row_width(df.schema) + text <= limit else df.hint("merge")


#: Keys that are spelled out as a filter.
LISTED_KEYS = 10_000


def keep_listed(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The rows of ``df`` whose ``column`` is among ``keys``, a written table.

    A few keys become a filter, which storage and unfolding steps see before they make
    rows; more are a semi-join.
    """
    few = keys.select(column).where(F.col(column).isNotNull()).distinct()
    listed = [r[0] for r in few.limit(LISTED_KEYS + 1).collect()]
    if len(listed) <= LISTED_KEYS:
        return df.where(F.col(column).isin(listed))
    return df.join(broadcast_if_small(few), column, "left_semi")
