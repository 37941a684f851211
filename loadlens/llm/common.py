"""Row identity, stored tables and small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.session import scratch_path

# Rows of a Python batch; whole texts travel, so a batch stays small.
BATCH_ROWS = 500


def free_name(base: str, taken: Iterable[str]) -> str:
    """``base``, with underscores appended until no column has that name."""
    used = {t.lower() for t in taken}
    while base.lower() in used:
        base += "_"
    return base


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Store ``df`` as Parquet in the shared folder and read it back.

    Lost executors cost no more than a rerun of the reading task.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def located(docs: DataFrame, loc: str = "loc") -> DataFrame:
    """Add a locator that names each stored row: file and row number in it.

    Rows that do not come straight from files are stored first, so that two
    equal rows still have two locators and a rerun gives the same ones.
    """

    def tagged(df: DataFrame) -> DataFrame:
        meta = df.metadataColumn("_metadata")
        where = F.concat_ws("#", meta["file_path"], meta["row_index"])
        return df.select(*[df[f"`{c}`"] for c in df.columns], where.alias(loc))

    try:
        return tagged(docs)
    except PySparkException:
        return tagged(write_table(docs, "rows"))


def keep_located(docs: DataFrame, loc: str, kept: DataFrame) -> DataFrame:
    """The rows of located ``docs`` whose locator is in ``kept``, without the locator."""
    names = [c for c in docs.columns if c != loc]
    return docs.join(unsent(kept.select(F.col(kept.columns[0]).alias(loc))), loc, "left_semi").select(*[F.col(f"`{c}`") for c in names])


def unsent(df: DataFrame) -> DataFrame:
    """Mark a table with about a row per input row: no join may broadcast it.

    Spark takes a table for too small if its rows were exploded or its file packs
    well, and would hand all of it to the driver.
    """
    return df.hint("merge")


def whole_text(name: str = "text") -> Column:
    """The text with NULL as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows that a Python worker holds at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Rows that no learner may see: the checksum of the id leaves no remainder."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == 0, F.lit(False))
