"""Feature preparation, tree and logistic models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.skew import lookup
from skein.operators.order import with_row_index
from skein.operators.shape import binarise, require_not_null, try_numeric
from skein.session import cut, new_folder
from skein.sources.files import union_all


def fit_categories(df: DataFrame, cols: list[str]) -> DataFrame:
    """Index of every value per column, ``(column, value, index)``: most frequent first, then by value.

    One pass counts all columns. Labels never pass through the driver, so their number is free.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]))
    counted = df.select(pairs.alias("_p")).select("_p.*").dropna().groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"))
    ranked = with_row_index(counted, ["column", F.col("n").desc(), "value"], "_at")
    firsts = ranked.groupBy("column").agg(F.min("_at").alias("_first"))  # one row per column
    return cut(ranked.join(F.broadcast(firsts), "column").select(
        "column", "value", (F.col("_at") - F.col("_first")).cast("int").alias("index")))


def index_categories(df: DataFrame, cols: list[str], index: DataFrame | None = None,
                     suffix: str = "Index") -> DataFrame:
    """Add an integer index for each text column; values unknown to ``index`` get null."""
    index = fit_categories(df, cols) if index is None else index
    for c in cols:
        known = index.filter(F.col("column") == c).select(
            F.col("value").alias(c), F.col("index").alias(f"{c}{suffix}"))
        df = lookup(df, known, c, "left")
    return df


def assemble(df: DataFrame, cols: list[str], handle_invalid: str = "error",
             name: str = "features") -> DataFrame:
    """Collect numeric columns into a vector; rows with nulls fail or are skipped."""
    return VectorAssembler(inputCols=cols, outputCol=name, handleInvalid=handle_invalid).transform(df)


def train_classifier(train: DataFrame, algo: str = "rf", label: str = "label",
                     features: str = "features", seed: int = 42, **params):
    """Fit a random forest (``rf``) or a logistic regression (``lr``).

    A fitted model of two classes keeps a summary that holds the session, which tasks cannot be sent once the session has
    observed a frame. The model is therefore written and read back, which leaves the summary out.
    """
    if algo == "lr":
        estimator = LogisticRegression(featuresCol=features, labelCol=label, **params)
    else:
        estimator = RandomForestClassifier(featuresCol=features, labelCol=label, seed=seed, **params)
    model = _fit(estimator, train.select(features, label))
    folder = new_folder(train.sparkSession, "model")
    model.write().save(folder)
    return type(model).load(folder)


def train_regressor(train: DataFrame, label: str, features: str = "features", seed: int = 42, **params):
    """Fit a regression tree."""
    tree = DecisionTreeRegressor(featuresCol=features, labelCol=label, seed=seed, **params)
    return _fit(tree, train.select(features, label))


# Rows of a training task. Kept rows are several times larger than the files they come from.
TRAIN_ROWS = 1 << 18


def _fit(estimator, train: DataFrame):
    """Training passes over its rows many times, so they are kept for as long as it lasts.

    Beyond one task's rows they are dealt out evenly, so that tasks grow in number, not in size.
    """
    tasks = -(-train.count() // TRAIN_ROWS)
    if tasks > 1:
        train = train.repartition(max(tasks, train.sparkSession.sparkContext.defaultParallelism))
    train = train.persist()
    try:
        return estimator.fit(train)
    finally:
        train.unpersist()


def accuracy(predictions: DataFrame, label: str = "label", prediction: str = "prediction",
             name: str = "accuracy") -> DataFrame:
    """Share of predictions that equal the label."""
    return predictions.agg(F.avg((F.col(prediction) == F.col(label)).cast("int")).alias(name))


@dataclass
class DelaySpec:
    """Columns of a delay table: what must hold, what is measured, what describes a row."""

    delay: str
    numeric: list[str]
    plain: list[str]
    categories: list[str]
    keep: Column | None = None
    threshold: float = 0
    null_label: str = "drop"

    @property
    def required(self) -> list[str]:
        return [*self.plain, *self.numeric, *self.categories, self.delay]

    @property
    def features(self) -> list[str]:
        return [*self.plain, *self.numeric, *[f"{c}Index" for c in self.categories]]


def prepare_delay_features(frames: list[DataFrame], spec: DelaySpec,
                           extra: list[str] | None = None) -> DataFrame:
    """Union the years, drop cancelled and incomplete rows, label delays, index the categories."""
    extra = extra or []
    rows = union_all(frames)
    if spec.keep is not None:
        rows = rows.filter(spec.keep)
    rows = require_not_null(rows, spec.required).select(*extra, *spec.required)
    rows = binarise(try_numeric(rows, [spec.delay]), spec.delay, spec.threshold, spec.null_label)
    rows = try_numeric(rows, spec.numeric, "int")
    # The categories are counted and the rows are used more than once, so the joined rows are written first.
    return index_categories(cut(rows), spec.categories).drop(*spec.categories)
