"""Session settings and the two helpers that need a shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup table is broadcast only if it has been measured to stay below these.
BROADCAST_ROWS = 500_000
BROADCAST_CHARS = 64 * 1024 * 1024


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "loadlens") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master, where
    driver and executors share one disk, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="loadlens-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that it survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def measured(table: DataFrame) -> DataFrame:
    """Mark a stored lookup table for broadcast if it is small.

    Beyond the bounds the join is left to the optimiser: a shuffle join, in which
    adaptive execution splits hot keys.
    """
    width = sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) for c in table.columns), F.lit(0))
    rows, chars = table.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(table) if rows <= BROADCAST_ROWS and chars <= BROADCAST_CHARS else table


def as_lookup(df: DataFrame) -> DataFrame:
    """Materialise a lookup table, then measure it."""
    return measured(cut_lineage(df))
