"""Exact deduplication by a stateful stream over content digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm.common import free_name, keep_located, located, whole_text, write_table
from loadlens.session import measured, scratch_path

#: Characters that do not count when texts are compared: U+0020 and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
#: Files of digests that one streaming batch reads at most.
FILES_PER_BATCH = 2_000
_LOG = "key binary, text_sha256 string, n_points int, doc_id long, loc string"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_DISK_STATE = {
    _PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Many small stores: do not reserve disk ahead for each.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def normalised(text: str = "text") -> Column:
    return F.translate(whole_text(text), BLANKS, "")


def _key(bits: int, turn: int) -> Column:
    """Key of the state: the digest, or a salted short one after a collision."""
    if bits >= 256:
        return F.unhex("text_sha256")
    salted = F.sha2(F.concat(F.lit(f"{turn}:"), F.col("text_sha256")), 256)
    return F.unhex(F.substring(salted, 1, max(2, bits // 4 // 2 * 2)))


def keyed_state(log: DataFrame, checkpoint: str | None = None, source_path: str | None = None) -> DataFrame:
    """Stream the digest log through keyed state and return the state's rows.

    The state lives in RocksDB on the executors' disks and in the checkpoint
    folder; it has no watermark, so no key ever expires. Each key keeps how
    many rows had it and the best of them: most code points, then smallest
    id, then locator. ``log`` is a stored table. With a ``checkpoint`` from an
    earlier call the stream goes on from its state and reads only files added
    to ``source_path`` (the folder of ``log``) since; without one it starts
    anew. A batch reads at most ``FILES_PER_BATCH`` files.
    """
    spark = log.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "dedup-state")
    source_path = source_path or log.inputFiles()[0].rsplit("/", 1)[0]
    before = {name: spark.conf.get(name, None) for name in _DISK_STATE}
    try:
        for name, value in _DISK_STATE.items():
            spark.conf.set(name, value)
        source = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(source_path)
        best = F.struct((-F.col("n_points")).alias("minus_points"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "loc")
        counted = source.groupBy("key").agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("n"))
        stream = counted.writeStream.format("noop").outputMode("update")
        stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    kept = spark.read.format("statestore").load(checkpoint).select("key.*", "value.*").toDF("key", "best", "n")
    return kept.select("key", F.col("best.doc_id").alias("keep_id"), F.col("best.loc").alias("keep_loc"), "n")


def _digested(docs: DataFrame, loc: str) -> DataFrame:
    rows = docs.select(F.col("doc_id"), F.col(loc).alias("loc"), normalised().alias("norm"), F.length(whole_text()).alias("n_points"))
    return rows.withColumn("text_sha256", F.sha2("norm", 256))


def _differing(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Locators of hits whose full text is not that of the row their key keeps."""
    shared = measured(state.where("n > 1").select("key", "keep_loc"))
    hits = rows.join(shared, "key").select("key", "norm", "loc", "keep_loc")
    first = hits.where("loc = keep_loc").select("key", F.col("norm").alias("first_norm"))
    return hits.where("loc <> keep_loc").join(first, "key").where("norm <> first_norm").select("loc")


def _decisions(found: DataFrame) -> DataFrame:
    kept = (F.col("loc") == F.col("keep_loc")).alias("kept")
    return found.select("loc", "doc_id", "keep_id", "keep_loc", F.col("n").alias("group_size"), kept, "text_sha256")


def exact_dedup(docs: DataFrame, loc: str = "loc", digest_bits: int = 256) -> DataFrame:
    """One row per row of located ``docs``: which row of its equals stays.

    Texts are equal when identical without the characters of ``BLANKS``; NULL
    is the empty text. The row with most code points stays, then the smallest
    doc_id (NULL last), then the smallest locator, so of repeated rows exactly
    one stays. Digests find candidates; every hit is then compared in full
    with the row that stays. Rows whose digest lies (only with a short
    ``digest_bits``, as in tests) go through the stream again under a salted
    digest: each turn settles at least one text per key. Returns loc, doc_id,
    keep_id, keep_loc, group_size, kept, text_sha256; an empty table gives an
    empty result.
    """
    rows = _digested(docs, loc)
    settled: DataFrame | None = None
    turn = 0
    while True:
        keyed = rows.withColumn("key", _key(digest_bits, turn))
        log = write_table(keyed.select("key", "text_sha256", "n_points", "doc_id", "loc"), "digests")
        if not log.inputFiles() or log.isEmpty():
            break
        state = write_table(keyed_state(log), "state")
        wrong = write_table(_differing(keyed, state), "collisions")
        again = not wrong.isEmpty()
        found = log.join(state, "key")
        if again:
            found = found.join(wrong, "loc", "left_anti")
            sizes = found.groupBy("key").agg(F.count(F.lit(1)).alias("true_n"))
            found = found.join(sizes, "key").withColumn("n", F.col("true_n"))
        found = _decisions(found)
        settled = found if settled is None else settled.unionByName(found)
        if not again:
            break
        rows = rows.join(wrong, "loc", "left_semi")
        turn += 1
    if settled is None:
        return log.select(
            "loc",
            "doc_id",
            F.col("doc_id").alias("keep_id"),
            F.col("loc").alias("keep_loc"),
            F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept"),
            "text_sha256",
        )
    return settled


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with its own columns and one row of each group of equal texts."""
    loc = free_name("loc", docs.columns)
    rows = located(docs, loc)
    return keep_located(rows, loc, exact_dedup(rows, loc).where("kept").select("loc"))


def append_batch(docs: DataFrame, folder: str, batch: str) -> None:
    """Add the rows of ``docs`` (doc_id, text; others are left out) to the store in ``folder``.

    Texts are kept as they are under ``texts``, their digests, ids and
    locators under ``log``. A batch name serves once: a second use raises and
    adds nothing. A call that failed before it wrote the digests has added
    nothing either; hand the rows in again under another name. An empty
    ``docs`` adds no row. ``folder`` must be one that all executors reach.
    """
    spark = docs.sparkSession
    path = f"{folder}/texts/{batch}"
    stored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    stored.write.parquet(path)
    rows = _digested(located(spark.read.schema(stored.schema).parquet(path)), "loc").withColumn("key", _key(256, 0))
    rows.select("key", "text_sha256", "n_points", "doc_id", "loc").write.parquet(f"{folder}/log/{batch}")


def settle(spark: SparkSession, folder: str, batch: str | None = None) -> DataFrame:
    """Decisions on every row that ``append_batch`` ever added to ``folder``; columns as in ``exact_dedup``.

    The stream goes on from the state of the last call (``folder/state``), so
    only digests added since are read and sorted into it, and a call that was
    cut off can be repeated. A later row with more code points takes over its
    group: decisions on earlier rows may change. Full texts are compared for
    the keys that ``batch`` touches, for all keys without it. Two texts of one
    digest raise an error; ``exact_dedup`` tells such texts apart. A store
    without rows gives an empty result.
    """
    log = spark.read.schema(_LOG).parquet(f"{folder}/log/*")
    if log.isEmpty():
        empty = log.withColumns({"keep_id": F.col("doc_id"), "keep_loc": F.col("loc"), "n": F.lit(0).cast("long")})
        return _decisions(empty)
    state = write_table(keyed_state(log, f"{folder}/state", f"{folder}/log/*"), "state")
    touched = state
    if batch is not None:
        new = spark.read.schema(_LOG).parquet(f"{folder}/log/{batch}")
        touched = state.join(new.select("key").distinct(), "key", "left_semi")
    texts = located(spark.read.schema("doc_id long, text string").parquet(f"{folder}/texts/*"))
    wrong = _differing(_digested(texts, "loc").withColumn("key", _key(256, 0)), touched)
    if not wrong.isEmpty():
        raise ValueError("different texts share a digest; settle the whole table with exact_dedup")
    return _decisions(log.join(state, "key"))
