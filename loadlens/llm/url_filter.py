"""URL filter: longest-match rules, and boosted trees on lexical features for the rest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import write_table
from loadlens.session import as_lookup

#: (verdict, host, path); a rule covers its host with all subdomains, below its path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Labels where neither a rule nor the caller gives one: block for a host with one of these words.
SEED_WORDS = ("casino", "pills", "spam", "bets", "adult", "ads")
#: At most so many labelled urls are used per fit, chosen by a hash of the url.
SAMPLE_ROWS = 20_000
#: Hosts fall into so many folds; the trees that judge a fold have seen none of its hosts.
FOLDS = 5
TREES, DEPTH = 15, 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

FEATURES = [
    "url_length",
    "host_length",
    "depth",
    "digit_ratio",
    "entropy",
    "n_params",
    "n_labels",
    "n_hyphens",
    "has_fragment",
    "suffix_urls",
    "suffix_hosts",
    "suffix_length",
    "suffix_entropy",
]


def url_parts(url: str = "url") -> dict[str, Column]:
    """host (A-Z lowered), path and the rest of a url; all empty without ``://``."""
    whole = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(whole, "://")
    rest = F.when(at > 0, F.substring(whole, at + 3, F.length(whole))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return {"host": host, "path": path, "tail": F.regexp_extract(rest, r"^[^?#]*([\s\S]*)$", 1)}


def rule_columns(rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits host and path, else NULL."""
    host, path = F.col("host"), F.col("path")
    rule = verdict = F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _entropy(text: Column) -> Column:
    """Bits per character of a short text."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")

    def part(c: Column) -> Column:
        p = (F.length(text) - F.length(F.replace(text, c))) / n
        return -p * F.log2(p)

    return F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), lambda acc, c: acc + F.when(F.length(c) > 0, part(c)).otherwise(0.0))


def lexical(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, seeds: Sequence[str] = SEED_WORDS, labelled: DataFrame | None = None
) -> DataFrame:
    """page_id, host, path, rule, rule_verdict, label, fold and the lexical features of every url.

    The label is 1 (block) or 0: the rule's verdict where one fits, else what
    ``labelled`` (url, label; block wins over allow for a url named twice)
    says, else whether the host holds one of ``seeds``. No feature is made
    from labels.
    """
    parts = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("u"), *[c.alias(n) for n, c in url_parts().items()])
    rule, verdict = rule_columns(rules)
    given = F.lit(None).cast("double")
    if labelled is not None:
        named = labelled.where("url IS NOT NULL AND label IS NOT NULL").groupBy(F.col("url").cast("string").alias("u"))
        parts = parts.join(as_lookup(named.agg(F.max(F.col("label").cast("double")).alias("given"))), "u", "left")
        given = F.col("given")
    seeded = F.lit(False)
    for word in seeds:
        seeded = seeded | F.col("host").rlike(rf"(^|[.\-]){word}([.\-]|$)")
    u, host, path, tail = F.col("u"), F.col("host"), F.col("path"), F.col("tail")
    count = lambda text, c: (F.length(text) - F.length(F.replace(text, F.lit(c)))).cast("double")
    size = F.greatest(F.length(u), F.lit(1)).cast("double")
    of_rule = F.when(F.col("rule_verdict").isNotNull(), (F.col("rule_verdict") == "block").cast("double"))
    return parts.withColumns({"rule": rule, "rule_verdict": verdict}).select(
        "page_id",
        "host",
        "path",
        "rule",
        "rule_verdict",
        F.coalesce(of_rule, given, seeded.cast("double")).alias("label"),
        (F.crc32(host) % FOLDS).cast("int").alias("fold"),
        F.substring_index(host, ".", -1).alias("suffix"),
        F.xxhash64("u").alias("order"),
        F.length(u).cast("double").alias("url_length"),
        F.length(host).cast("double").alias("host_length"),
        count(path, "/").alias("depth"),
        (F.length(u) - F.length(F.translate(u, "0123456789", ""))).cast("double").__truediv__(size).alias("digit_ratio"),
        _entropy(u).alias("entropy"),
        (count(tail, "=") + count(tail, "&")).alias("n_params"),
        count(host, ".").alias("n_labels"),
        count(host, "-").alias("n_hyphens"),
        count(tail, "#").alias("has_fragment"),
    )


def suffix_statistics(urls: DataFrame) -> DataFrame:
    """Per suffix, over all rows: urls and hosts (logarithms), mean length and entropy; nothing from labels.

    Rows are summed per host first, so that a hot host or suffix is combined before it is shuffled.
    """
    hosts = urls.groupBy("suffix", "host").agg(F.count(F.lit(1)).alias("n"), F.sum("url_length").alias("length"), F.sum("entropy").alias("bits"))
    found = hosts.groupBy("suffix").agg(
        F.log1p(F.sum("n").cast("double")).alias("suffix_urls"),
        F.log1p(F.count(F.lit(1)).cast("double")).alias("suffix_hosts"),
        (F.sum("length") / F.sum("n")).alias("suffix_length"),
        F.round(F.sum("bits") / F.sum("n"), 9).alias("suffix_entropy"),
    )
    return as_lookup(found)


def fit(rows: DataFrame, trees: int = TREES, depth: int = DEPTH) -> Model | None:
    """Boosted trees on a stored sample; None where only one class is there."""
    n, ones = rows.agg(F.count("*"), F.sum("label")).first()
    if not n or ones in (0, n):
        return None
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select("label", "features").cache()
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=7).fit(vectors)
    vectors.unpersist()
    return model


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    sample: int = SAMPLE_ROWS,
    seeds: Sequence[str] = SEED_WORDS,
    labelled: DataFrame | None = None,
) -> DataFrame:
    """page_id, host, path, rule, verdict, score and label of every row of ``pages``.

    Rules decide where they fit. Elsewhere boosted trees on lexical features
    decide. Hosts fall into ``FOLDS`` folds by checksum, and a url is judged
    by trees fitted without any url of its fold: neither its label nor that
    of another url of its host reaches its score, so scores against labels
    are held-out figures (``held_out_quality``). A url that is NULL or has no
    ``://`` has empty host and path and is judged by the trees like any
    other; a very long url is read whole, repeated rows are judged alike. A
    fold whose other folds hold one class only takes that class, and allow
    where they are empty. An empty table gives an empty result.
    """
    urls = write_table(lexical(pages, rules, seeds, labelled), "urls")
    urls = urls.join(suffix_statistics(urls), "suffix", "left")
    with_vector = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(urls)
    counts = {r.fold: (r.n, r.ones) for r in urls.groupBy("fold").agg(F.count("*").alias("n"), F.sum("label").alias("ones")).collect()}
    parts = []
    for fold in sorted(counts):
        n = sum(c[0] for f, c in counts.items() if f != fold)
        ones = sum(c[1] for f, c in counts.items() if f != fold)
        model = None
        if 0 < ones < n:
            chosen = urls.where(F.col("fold") != fold).select("label", *FEATURES, "order", "page_id").orderBy("order", "page_id").limit(sample)
            model = fit(write_table(chosen, "url-sample"))
        own = with_vector.where(F.col("fold") == fold)
        if model is None:
            score = F.lit(1.0 if n and 2 * ones > n else 0.0)
        else:
            own, score = model.transform(own), F.get(vector_to_array("probability"), F.lit(1))
        parts.append(own.select("page_id", "host", "path", "rule", "rule_verdict", score.alias("score"), "label"))
    scored = reduce(DataFrame.unionByName, parts) if parts else with_vector.withColumn("score", F.lit(0.0))
    own = F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"), "score", "label")


def held_out_quality(judged: DataFrame) -> DataFrame:
    """One row: n, positives, hits and false alarms of the scores where no rule decides, precision and recall.

    Every score comes from trees that saw no url of the row's host.
    """
    free, yes, says = F.col("rule").isNull(), F.col("label") == 1, F.col("score") >= 0.5
    count = lambda c: F.count_if(free & c)
    sums = judged.agg(
        F.count_if(free).alias("n"), count(yes).alias("positives"), count(yes & says).alias("hits"), count(~yes & says).alias("false_alarms")
    )
    found = F.col("hits") + F.col("false_alarms")
    return sums.withColumns({"precision": F.try_divide("hits", found), "recall": F.try_divide("hits", "positives")})
