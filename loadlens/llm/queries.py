"""Registered queries over the operators; each derives the columns its contract names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm import (
    byte_pieces,
    decontaminate,
    exact_dedup,
    html_extract,
    mixing,
    periodic_runs,
    quality,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filter,
    whitening,
)
from loadlens.llm.common import located, table

Query = Callable[[SparkSession, str], DataFrame]

_registry: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _registry[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_registry)


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return located(table(spark, folder, "documents"))


@_query
def op1_exact_dedup(spark, folder):
    found = exact_dedup.exact_dedup(_documents(spark, folder))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@_query
def op5_source_mixing(spark, folder):
    return mixing.mix_sources(table(spark, folder, "documents"))


@_query
def op7_simhash(spark, folder):
    found = simhash.near_duplicates(_documents(spark, folder))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query
def op8_decontamination(spark, folder):
    found = decontaminate.scan(_documents(spark, folder), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@_query
def op10_quality(spark, folder):
    found = quality.score(_documents(spark, folder), table(spark, folder, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


@_query
def op3_html_extraction(spark, folder):
    found = html_extract.extract(table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@_query
def op6_url_filter(spark, folder):
    return url_filter.judge(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


@_query
def op2_toxicity(spark, folder):
    found = toxicity.score(_documents(spark, folder), table(spark, folder, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


@_query
def op9_token_counts(spark, folder):
    found = token_counts.counts_after_masking(_documents(spark, folder))
    return found.select("doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_leaves", "n_reencoded")


@_query
def op4_suffix_dedup(spark, folder):
    found = suffix_dedup.remove_repeats(_documents(spark, folder))
    return found.select("doc_id", "n_bytes", F.col("n_removed").cast("long"), F.col("n_spans").cast("long"), "kept_sha256")


@_query
def op11_whitening(spark, folder):
    return whitening.whiten(table(spark, folder, "embeddings"))


@_query
def op12_byte_bpe(spark, folder):
    import public_tokenizers

    tool = byte_pieces.tokenizer(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = byte_pieces.encode(table(spark, folder, "documents"), tool, ["doc_id"])
    counted = encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), "ids"
    )
    decoded = byte_pieces.decode(counted, tool, ["doc_id", "n_tokens", "ids_sha256"])
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents of which those with a checksum of the id divisible by 10 repeat a stretch of their words to the end."""
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    marked = docs.withColumns({"_h": F.crc32(F.col("doc_id").cast("string")), "_w": words}).withColumn("_n", F.size("_w").cast("long"))
    g = F.floor(F.col("_h") / 10)
    marked = marked.withColumn("_a", F.when(F.col("_n") > 0, F.pmod(g, F.col("_n"))))
    marked = marked.withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.pmod(g, F.lit(8))))).cast("long"))
    at = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + F.pmod(i - F.col("_a"), F.col("_p")))
    planted = F.concat_ws(" ", F.transform(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1), lambda i: F.get("_w", at(i).cast("int"))))
    chosen = (F.col("_h") % 10 == 0) & (F.col("_n") > 0)
    return marked.withColumn("text", F.when(chosen, planted).otherwise(F.col("text"))).drop("_h", "_w", "_n", "_a", "_p")


@_query
def op13_periodic_runs(spark, folder):
    found = periodic_runs.collapse(with_planted_runs(_documents(spark, folder)), ["doc_id"])
    found = found.withColumn("_top", periodic_runs.strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    top = F.col("_top")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        top["start"].alias("start"),
        top["length"].alias("length"),
        top["period"].alias("period"),
        F.expr("1000 * _top.length div _top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
