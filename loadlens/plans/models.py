"""Regression models on mixed text and numeric features, on ``pyspark.ml``."""

from __future__ import annotations

import json
import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens import constants as K
from loadlens.functions.cleaning import filled, present
from loadlens.operators import deep_forest
from loadlens.operators.deep_forest import DeepForest
from loadlens.operators.groups import encode_labels, label_counts, number_labels
from loadlens.session import cut_lineage
from loadlens.sources.models import load_model, save_model

# Label lists up to this total length live in the saved indexer stage, which the
# driver builds label by label. Longer ones are tables that are joined instead.
MAX_LABELS = 2_000
# Deepest tree the learner accepts.
MAX_DEPTH = 30
# Deeper trees have about a leaf per row, too many nodes for the learner.
SHALLOW = 10
# A learner's input always has so many partitions. A forest draws its rows per
# partition, so this number is part of the model; raise it for larger inputs.
LEARN_PARTITIONS = 16


@dataclass
class Encoders:
    """Fitted label indices: an indexer stage, and label tables for long lists."""

    stages: list[Transformer] = field(default_factory=list)
    sizes: dict[str, int] = field(default_factory=dict)
    tables: DataFrame | None = None
    joined: list[str] = field(default_factory=list)

    def look_up(self, df: DataFrame) -> DataFrame:
        """Index the columns with long label lists by a join."""
        for c in self.joined:
            df = encode_labels(df, c, self.tables, "_found")
            df = df.withColumn(f"_{c}", F.coalesce("_found", F.lit(self.sizes[c])).cast("double")).drop("_found")
        return df

    def index(self, df: DataFrame) -> DataFrame:
        """Add ``_<column>`` for every encoded column."""
        return PipelineModel(self.stages).transform(self.look_up(df))


def text_features(df: DataFrame, features: list[str]) -> list[str]:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return [f for f in features if isinstance(kinds[f], T.StringType)]


def fit_encoders(df: DataFrame, columns: list[str], max_labels: int = MAX_LABELS) -> Encoders:
    """Index labels by falling frequency, all columns in one distributed count.

    An unseen label gets the index after the last one, so no row is dropped.
    """
    if not columns:
        return Encoders()
    counts = cut_lineage(label_counts(df.withColumns({c: filled(c) for c in columns}), columns))
    sizes = {r["feature"]: r["count"] for r in counts.groupBy("feature").count().collect()}
    sizes = {c: sizes.get(c, 0) for c in columns}
    room, short = max_labels, []
    for c in sorted(columns, key=sizes.get):
        if sizes[c] <= room:
            room -= sizes[c]
            short.append(c)
    short = [c for c in columns if c in short]
    long = [c for c in columns if c not in short]
    labels: dict[str, list[str]] = {c: [] for c in short}
    for r in counts.filter(F.col("feature").isin(short)).orderBy("feature", F.desc("n"), "label").collect():
        labels[r["feature"]].append(r["label"])
    stages: list[Transformer] = []
    if short:
        # A missing text is the empty label, in training and in scoring.
        texts = ", ".join(f"COALESCE(`{c}`, '') AS `_text_{c}`" for c in short)
        stages.append(SQLTransformer(statement=f"SELECT *, {texts} FROM __THIS__"))
        stages.append(
            StringIndexerModel.from_arrays_of_labels(
                [labels[c] for c in short], [f"_text_{c}" for c in short], [f"_index_{c}" for c in short], "keep"
            )
        )
        # Without the label metadata a learner treats the index as a number.
        plain = ", ".join(f"CAST(`_index_{c}` AS DOUBLE) AS `_{c}`" for c in short)
        stages.append(SQLTransformer(statement=f"SELECT *, {plain} FROM __THIS__"))
    tables = cut_lineage(number_labels(counts.filter(F.col("feature").isin(long)))) if long else None
    return Encoders(stages, sizes, tables, long)


def _one_hot(spark: SparkSession, columns: list[str], sizes: dict[str, int]) -> list[Transformer]:
    """Dummy coding ``_hot_<column>`` against the most frequent label.

    That label and unseen ones are all zero, which keeps the equations regular.
    The list lengths are known, so the encoder is fitted on one row, not on the data.
    """
    last = {c: max(sizes[c], 2) - 1 for c in columns}
    moved = ", ".join(
        f"CAST(IF(`_{c}` = 0 OR `_{c}` >= {sizes[c]}, {last[c]}, `_{c}` - 1) AS DOUBLE) AS `_level_{c}`" for c in columns
    )
    top = spark.createDataFrame([[float(last[c]) for c in columns]], [f"_level_{c}" for c in columns])
    encoder = OneHotEncoder(inputCols=top.columns, outputCols=[f"_hot_{c}" for c in columns])
    return [SQLTransformer(statement=f"SELECT *, {moved} FROM __THIS__"), encoder.fit(top)]


@dataclass
class Model:
    """A fitted regression: features in, ``prediction`` out."""

    stages: PipelineModel
    encoders: Encoders
    features: list[str]
    about: dict = field(default_factory=dict)
    forest: DeepForest | None = None

    def predict(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Rows of ``df`` with ``prediction``; helper columns are dropped."""
        keep = list(df.columns if keep is None else keep)
        ready = self.stages.transform(self.encoders.look_up(df))
        if self.forest is None:
            return ready.select(*keep, "prediction")
        return self.forest.predict(ready.select(*keep, vector_to_array("features").alias("_features")), keep, "_features")

    def save(self, path: str) -> None:
        save_model(self.stages, f"{path}/stages")
        spark = SparkSession.active()
        if self.encoders.tables is not None:
            self.encoders.tables.write.mode("overwrite").partitionBy("feature").parquet(f"{path}/labels")
        facts = {"features": self.features, "sizes": self.encoders.sizes, "joined": self.encoders.joined, "about": self.about}
        if self.forest is not None:
            self.forest.pieces.write.mode("overwrite").parquet(f"{path}/pieces")
            facts["forest"] = self.forest.note()
        note = json.dumps(facts)
        spark.createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Model:
        about = json.loads(spark.read.text(f"{path}/about").first()[0])
        tables = spark.read.parquet(f"{path}/labels") if about["joined"] else None
        encoders = Encoders([], about["sizes"], tables, about["joined"])
        forest = DeepForest.of(about["forest"], spark.read.parquet(f"{path}/pieces")) if "forest" in about else None
        return Model(load_model(f"{path}/stages"), encoders, about["features"], about.get("about", {}), forest)


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` cached while a learner passes over it again and again."""
    df = df.persist()
    try:
        yield df
    finally:
        df.unpersist()


def placed(df: DataFrame, columns: list[str], partitions: int) -> DataFrame:
    """Rows put into a fixed number of partitions, in an order, both by their content only.

    So neither the number of cores nor the layout of the input changes a model.
    """
    place = F.xxhash64(*columns)
    return df.withColumn("_place", place).repartition(partitions, "_place").sortWithinPartitions("_place", *columns)


def missing_counts(df: DataFrame, features: list[str], target: str = K.TARGET) -> DataFrame:
    """Rows in all, rows without a target (never learned from), and missing numbers per feature (learned as 0)."""
    numbers = [f for f in features if f not in text_features(df, features)]
    counts = [F.count_if(present(F.col(c).cast("double")).isNull()).alias(f"missing_{c.lower()}") for c in [target, *numbers]]
    return df.agg(F.count("*").alias("n"), *counts)


@dataclass
class Deep:
    """What a deep forest is fitted with."""

    target: str
    trees: int
    depth: int
    bins: int
    rows: float
    columns: str
    seed: int

    def getLabelCol(self) -> str:
        return self.target

    def settings(self, n: int) -> deep_forest.Settings:
        subset = deep_forest.subset_size(self.columns, n, self.trees)
        return deep_forest.Settings(self.trees, self.depth, self.bins, self.rows, subset, self.seed)


def _fit(
    df: DataFrame,
    features: list[str],
    learner,
    one_hot: bool,
    max_labels: int,
    indexed: Encoders | None = None,
    partitions: int = LEARN_PARTITIONS,
) -> Model:
    """Fit a learner. With ``indexed``, the rows already carry the ``_<column>`` of those encoders.

    A missing number (NULL, NaN, infinite) is 0, as the null literal is, in
    training and in scoring. Rows without a target are not learned from.
    """
    text = text_features(df, features)
    numbers = [f for f in features if f not in text]
    encoders = indexed or fit_encoders(df, text, max_labels)
    tail: list[Transformer] = []
    prefix = "_"
    if one_hot and text:
        tail += _one_hot(df.sparkSession, text, encoders.sizes)
        prefix = "_hot_"
    columns = [prefix + c for c in text] + [f"_number_{c}" for c in numbers]
    if numbers:
        whole = ", ".join(f"IF(ABS(CAST(`{c}` AS DOUBLE)) < DOUBLE('Infinity'), CAST(`{c}` AS DOUBLE), 0D) AS `_number_{c}`" for c in numbers)
        tail.append(SQLTransformer(statement=f"SELECT *, {whole} FROM __THIS__"))
    tail.append(VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep"))
    target = learner.getLabelCol()
    rows = df.filter(present(F.col(target).cast("double")).isNotNull())
    if indexed is None:
        rows = encoders.index(rows.select(target, *features))
    rows = placed(rows, [target, *[f"_{c}" for c in text], *numbers], partitions)
    front = [] if indexed else encoders.stages
    ready = PipelineModel(tail).transform(rows)
    if isinstance(learner, Deep):
        ready = ready.select(target, vector_to_array("features").alias("_features"), "_place")
        forest = deep_forest.fit(ready, target, "_features", len(columns), "_place", learner.settings(len(columns)))
        return Model(PipelineModel([*front, *tail]), encoders, list(features), forest=forest)
    with kept(ready.select(target, "features")) as train:
        fitted = learner.fit(train)
    return Model(PipelineModel([*front, *tail, fitted]), Encoders() if indexed else encoders, list(features))


def fit_linear(
    df: DataFrame,
    features: list[str],
    target: str = K.TARGET,
    iterations: int = 100,
    reg: float = 0.0,
    solver: str = "auto",
    max_labels: int = MAX_LABELS,
    indexed: Encoders | None = None,
) -> Model:
    """Linear regression; text features dummy coded.

    Up to 4096 encoded columns the normal equations are built in one pass over
    the data; beyond that the iterative solver runs.
    """
    learner = LinearRegression(
        labelCol=target, featuresCol="features", maxIter=iterations, regParam=reg, solver=solver
    )
    return _fit(df, features, learner, one_hot=True, max_labels=max_labels, indexed=indexed)


def fit_forest(
    df: DataFrame,
    features: list[str],
    target: str = K.TARGET,
    trees: int = 50,
    depth: int = 25,
    bins: int = 1024,
    rows: float = 1.0,
    columns: str = "auto",
    seed: int = 1,
    max_labels: int = MAX_LABELS,
    partitions: int = LEARN_PARTITIONS,
) -> Model:
    """Random forest; a label index counts as a number, so no list is too long for the bins.

    The learner takes depths up to ``MAX_DEPTH``; a greater one is fitted with
    that depth, with a warning, and the model's ``about`` names both. Trees
    deeper than ``SHALLOW`` are grown by ``deep_forest``, to the same rules.
    """
    if depth > MAX_DEPTH:
        warnings.warn(f"depth {depth} is beyond the learner's limit, fitted with {MAX_DEPTH}", stacklevel=2)
    about = {"trees": trees, "depth": min(depth, MAX_DEPTH), "wanted_depth": depth, "partitions": partitions}
    if depth > SHALLOW:
        # Its draws do not depend on the partitions.
        spread = max(partitions, df.sparkSession.sparkContext.defaultParallelism)
        deep = Deep(target, trees, min(depth, MAX_DEPTH), bins, rows, columns, seed)
        model = _fit(df, features, deep, one_hot=False, max_labels=max_labels, partitions=spread)
        model.about = about
        return model
    learner = RandomForestRegressor(
        labelCol=target,
        featuresCol="features",
        numTrees=trees,
        maxDepth=min(depth, MAX_DEPTH),
        maxBins=bins,
        impurity="variance",
        subsamplingRate=rows,
        featureSubsetStrategy=columns,
        seed=seed,
        maxMemoryInMB=1024,
    )
    model = _fit(df, features, learner, one_hot=False, max_labels=max_labels, partitions=partitions)
    model.about = about
    return model
