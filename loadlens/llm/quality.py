"""Quality classifier: a sparse ensemble of rules taken from trees."""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import free_name, held_out, keep_located, located, small_batches, whole_text, write_table

#: At most so many labelled rows are used to fit, chosen by a hash of their id.
SAMPLE_ROWS = 20_000
#: A document scored below this is rejected.
ACCEPT = 0.3
TREES, DEPTH, LASSO = 12, 3, 0.001

STATISTICS = [
    "log_bytes",
    "log_words",
    "log_lines",
    "word_bytes",
    "upper_share",
    "digit_share",
    "symbol_share",
    "bang_share",
    "pipe_share",
    "blank_share",
    "stop_rate",
    "distinct_word_share",
    "repeated_word_share",
    "distinct_line_share",
    "lone_word_share",
]
_SYMBOLS = [b for b in b"#$%&*+/<=>@[\\]^_`{|}~!?"]


def statistics(text: str) -> list[float]:
    """The numbers of STATISTICS for one whole text; all 0 for an empty one."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    size, n = len(raw), len(words)
    count = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    letters = count[65:91].sum() + count[97:123].sum() + count[0xC3:].sum()
    # Capitals beyond ASCII are counted by the change of their lower-cased form.
    upper = count[65:91].sum() + (0 if raw.isascii() else sum(a != b for a, b in zip(text, text.lower()) if a > "\x7f"))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [
        float(np.log1p(size)),
        float(np.log1p(n)),
        float(np.log1p(len(lines))),
        float(sum(map(len, words)) / n),
        float(upper / max(1, letters)),
        float(count[48:58].sum() / size),
        float(count[_SYMBOLS].sum() / size),
        float(count[33] / size),
        float(count[124] / size),
        float((count[32] + count[9:14].sum()) / size),
        float((count[46] + count[63]) / n),
        float(len(set(words)) / n),
        float(sum(map(operator.eq, words, words[1:])) / n),
        float(len(set(lines)) / len(lines)),
        float(sum(len(w) == 1 for w in words) / n),
    ]


def document_statistics(docs: DataFrame, loc: str = "loc") -> DataFrame:
    """(loc, doc_id, statistics...) per row of located ``docs``."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = np.array([statistics(t) for t in pdf["text"]], dtype=float).reshape(-1, len(STATISTICS))
            yield pd.concat([pdf[["loc", "doc_id"]].reset_index(drop=True), pd.DataFrame(values, columns=STATISTICS)], axis=1)

    rows = docs.select(F.col(loc).alias("loc"), F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInPandas(run, "loc string, doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS))


def labelled_sample(labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, label) of at most ``rows`` ids outside the held-out fold, in hash order.

    Rows without an id or a label are left out; of an id labelled twice the
    larger label counts.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
    once = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("double")).alias("label"))
    return once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


@dataclass(frozen=True)
class Rule:
    """A conjunction of comparisons: (statistic, is it at most, threshold)."""

    tests: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        parts = [F.col(name) <= F.lit(t) if at_most else F.col(name) > F.lit(t) for name, at_most, t in self.tests]
        whole = parts[0]
        for p in parts[1:]:
            whole = whole & p
        return whole


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules; without rules every document gets the base rate."""

    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    intercept: float

    def score(self) -> Column:
        """The ensemble as one column expression over the statistics."""
        total = F.lit(float(self.intercept))
        for rule, weight in zip(self.rules, self.weights):
            total = total + F.when(rule.column(), F.lit(float(weight))).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def _rules_of(tree) -> list[Rule]:
    """Every path from a tree's root to one of its nodes; contained bounds are merged."""
    found: list[Rule] = []

    def walk(node, bounds: dict[tuple[str, bool], float]) -> None:
        if bounds:
            found.append(Rule(tuple((n, low, t) for (n, low), t in sorted(bounds.items()))))
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, t = STATISTICS[split.featureIndex()], float(split.threshold())
        low, high = bounds.get((name, True), t), bounds.get((name, False), t)
        walk(node.leftChild(), bounds | {(name, True): min(low, t)})
        walk(node.rightChild(), bounds | {(name, False): max(high, t)})

    walk(tree._java_obj.rootNode(), {})
    return found


def fit(training: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> RuleModel:
    """Fit on a stored table of label and statistics.

    A forest proposes rules; a logistic regression with lasso penalty over
    them keeps few. With one class only, or no rows, the model has no rule:
    its score is the base rate, 0.5 without any row.
    """
    n, ones = training.agg(F.count("*"), F.sum("label")).first()
    if not n or ones in (0, n):
        rate = 0.5 if not n else (ones + 0.5) / (n + 1)
        return RuleModel((), (), float(np.log(rate / (1 - rate))))
    vectors = VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(training).select("label", "features").cache()
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", subsamplingRate=0.7, seed=7)
    rules = list(dict.fromkeys(r for tree in forest.fit(vectors).trees for r in _rules_of(tree)))
    vectors.unpersist()
    if not rules:
        return RuleModel((), (), float(np.log(ones / (n - ones))))
    flags = F.array(*[r.column().cast("double") for r in rules])
    matrix = training.select("label", array_to_vector(flags).alias("features")).cache()
    lr = LogisticRegression(elasticNetParam=1.0, regParam=lasso, standardization=False, maxIter=60, tol=1e-5).fit(matrix)
    matrix.unpersist()
    used = [(r, w) for r, w in zip(rules, lr.coefficients.toArray()) if w]
    return RuleModel(tuple(r for r, _ in used), tuple(float(w) for _, w in used), float(lr.intercept))


def train(stats: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> RuleModel:
    """Fit on the bounded labelled sample of a stored statistics table."""
    sample = F.broadcast(labelled_sample(labels, label, rows))
    return fit(write_table(stats.join(sample, "doc_id").orderBy("doc_id").coalesce(1), "training"))


def score(docs: DataFrame, labels: DataFrame, loc: str = "loc") -> DataFrame:
    """loc, doc_id, held_out, score, predicted per row of located ``docs``.

    NULL is the empty text; an id that labels do not know is scored like any
    other; repeated rows get equal scores; an empty table an empty result.
    """
    stats = write_table(document_statistics(docs, loc), "statistics")
    model = train(stats, labels)
    scored = stats.select("loc", "doc_id", held_out().alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def drop_rejected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with its own columns, without the documents the classifier rejects."""
    loc = free_name("loc", docs.columns)
    rows = located(docs, loc)
    return keep_located(rows, loc, score(rows, labels, loc).where("predicted = 1").select("loc"))
