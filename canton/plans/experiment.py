"""Logistic regression experiments and their comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from canton.functions import above_threshold, sigmoid, weighted_sum
from canton.functions.text import sql_name
from canton.operators.metrics import METRICS, classification_metrics, majority_class
from canton.operators.scaling import Scaler
from canton.operators.sparse import (
    feature_dictionary, ml_vectors, scaled_entries, sparse_scores, sparse_vectors, with_vectors,
)
from canton.operators.split import class_cuts, split_by
from canton.session import durable, stored_table
from canton.sources.literal import literal_table
from canton.sources.sinks import export_csv, export_json


@dataclass(frozen=True)
class LogitModel:
    features: tuple[str, ...]
    weights: tuple[float, ...]
    bias: float

    def predict(
        self,
        df: DataFrame,
        probability: str = "predicted_proba",
        prediction: str = "predicted_class",
    ) -> DataFrame:
        """Scores as plain column arithmetic inside the scan's stage."""
        score = weighted_sum(list(self.features), list(self.weights)) + F.lit(self.bias)
        return df.withColumn(probability, sigmoid(score)).withColumn(
            prediction, above_threshold(F.col(probability))
        )

    def importance(self, spark: SparkSession) -> DataFrame:
        """Coefficients by descending size; one row per feature."""
        df = literal_table(spark, ["feature", "coefficient"], list(zip(self.features, self.weights)))
        return df.withColumn("abs_coefficient", F.abs("coefficient")).orderBy(
            F.desc("abs_coefficient"), "feature"
        )


def _gradients(features: Sequence[str], label: str, weights: np.ndarray, bias: float):
    """Per task: the summed gradient of its rows, as one small row."""

    def run(batches):
        total = np.zeros(len(features) + 2)
        for batch in batches:
            x = np.column_stack(
                [batch.column(f).to_numpy(zero_copy_only=False) for f in features]
            ).astype(float)
            y = batch.column(label).to_numpy(zero_copy_only=False)
            score = np.clip(x @ weights + bias, -50.0, 50.0)
            error = 1.0 / (1.0 + np.exp(-score)) - y
            total[:-2] += error @ x
            total[-2] += error.sum()
            total[-1] += len(y)
        index = pa.array(np.arange(len(total)), pa.int32())
        yield pa.RecordBatch.from_arrays([index, pa.array(total)], names=["i", "g"])

    return run


def _descend(
    train: DataFrame, features: Sequence[str], label: str, lr: float, epochs: int, l2: float
) -> LogitModel:
    """Full-batch gradient descent from zero; only the gradient vector of an
    epoch reaches the driver. The bias is not regularised."""
    data = train.select(
        *[F.col(sql_name(f)).cast("double").alias(f) for f in features], F.col(label).cast("double")
    )
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    weights, bias = np.zeros(len(features)), 0.0
    try:
        for _ in range(epochs):
            parts = data.mapInArrow(_gradients(features, label, weights, bias), "i int, g double")
            sums = np.zeros(len(features) + 2)
            for r in parts.groupBy("i").agg(F.sum("g").alias("g")).collect():
                sums[r.i] = r.g
            n = sums[-1]
            weights = weights - lr * (sums[:-2] / n + l2 * weights)
            bias -= lr * sums[-2] / n
    finally:
        data.unpersist()
    return LogitModel(tuple(features), tuple(map(float, weights)), float(bias))


def fit_logit(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    solver: str = "mllib",
    l2: float = 0.001,
    lr: float = 0.05,
    epochs: int = 3000,
) -> LogitModel:
    """Binary logistic regression with an L2 penalty on scaled features.

    ``mllib`` minimises the objective with a few tree-aggregated passes.
    ``descent`` follows plain gradient descent step by step, one pass per
    epoch, for callers that need that very trajectory.
    """
    if solver == "descent":
        return _descend(train, features, label, lr, epochs, l2)
    if solver != "mllib":
        raise ValueError(f"unknown solver {solver}")
    # Plain names for the assembler, which cannot quote.
    plain = [f"f{i}" for i in range(len(features))]
    rows = VectorAssembler(inputCols=plain, outputCol="features__v").transform(
        train.select(
            *[F.col(sql_name(f)).alias(p) for f, p in zip(features, plain)],
            F.col(sql_name(label)).cast("double").alias("label__y"),
        )
    )
    fitted = _regression(l2).fit(rows.select("features__v", "label__y"))
    return LogitModel(
        tuple(features), tuple(map(float, fitted.coefficients)), float(fitted.intercept)
    )


def _regression(l2: float) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="features__v",
        labelCol="label__y",
        regParam=l2,
        elasticNetParam=0.0,
        standardization=False,
        family="binomial",
        maxIter=500,
        tol=1e-12,
    )


@dataclass(frozen=True)
class Experiment:
    name: str
    features: tuple[str, ...]
    model: LogitModel
    dataset: DataFrame
    predictions: DataFrame
    importance: DataFrame
    metrics: DataFrame

    @property
    def features_count(self) -> int:
        return len(self.features)

    def save(self, path: str) -> None:
        base = f"{path}/{self.name}"
        export_csv(self.dataset, f"{base}/model_dataset", sep=",")
        export_csv(self.predictions, f"{base}/test_predictions", sep=",")
        export_csv(self.importance, f"{base}/feature_importance", sep=",")
        export_json(metrics_document(self), f"{base}/metrics")


def run_experiment(
    name: str,
    dataset: DataFrame,
    features: Sequence[str],
    label: str,
    id_column: str,
    test: float = 0.2,
    seed: int = 42,
    cuts: DataFrame | None = None,
    **fit,
) -> Experiment:
    """Split, impute and scale, fit, predict and score one feature set.

    Pass a stored ``dataset``: the fit reads it repeatedly. ``cuts`` is a split
    that is known already.
    """
    spark = dataset.sparkSession
    narrow = dataset.select(id_column, label, *map(sql_name, features))
    if cuts is None:
        cuts = class_cuts(dataset, label, id_column, test, seed)
    train, held_out = split_by(narrow, cuts, label, id_column, seed)
    scaler = Scaler.fit(train, features)
    scaled = scaler.transform(train).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = fit_logit(scaled, features, label, **fit)
    finally:
        scaled.unpersist()
    scored = model.predict(scaler.transform(held_out))
    predictions = scored.select(id_column, label, "predicted_class", "predicted_proba")
    baseline = held_out.select(
        label, F.lit(majority_class(train, label)).alias("predicted_class")
    )
    metrics = (
        predictions.select(F.lit("model").alias("scored"), label, "predicted_class")
        .unionByName(baseline.select(F.lit("baseline").alias("scored"), label, "predicted_class"))
    )
    metrics = classification_metrics(metrics, label, "predicted_class", by=("scored",))
    return Experiment(
        name, tuple(features), model, narrow, predictions, model.importance(spark), metrics
    )


@dataclass(frozen=True)
class VectorExperiment:
    """An experiment on sparse vectors; its coefficients are a table (feature, index, coefficient)."""

    name: str
    features_count: int
    coefficients: DataFrame
    bias: float
    dataset: DataFrame
    predictions: DataFrame
    metrics: DataFrame

    @property
    def importance(self) -> DataFrame:
        size = F.abs("coefficient").alias("abs_coefficient")
        return self.coefficients.select("feature", "coefficient", size).orderBy(F.desc("abs_coefficient"), "feature")

    def save(self, path: str) -> None:
        base = f"{path}/{self.name}"
        export_csv(self.dataset, f"{base}/model_dataset", sep=",")
        export_csv(self.predictions, f"{base}/test_predictions", sep=",")
        export_csv(self.importance, f"{base}/feature_importance", sep=",")
        export_json(metrics_document(self), f"{base}/metrics")


def vector_ablation(
    labels: DataFrame,
    rows: DataFrame,
    feature_sets: Mapping[str, Column | None],
    label: str,
    id_column: str,
    test: float = 0.2,
    seed: int = 42,
    l2: float = 0.001,
) -> list[VectorExperiment]:
    """Experiments on long feature rows (id, feature, value): no column per feature.

    ``labels`` has one row per id; a set is a condition on ``feature``, or
    ``None`` for all. Split, statistics and scaling are made once; a set only
    leaves entries out. An id without rows has the mean of every feature. Only
    the fitted coefficients pass through the driver, as in any MLlib model.
    """
    spark = labels.sparkSession
    labels = stored_table(labels.select(id_column, label), "labels")
    cuts = class_cuts(labels, label, id_column, test, seed)
    train, held_out = split_by(labels, cuts, label, id_column, seed)
    parts = stored_table(
        train.withColumn("train", F.lit(True)).unionByName(held_out.withColumn("train", F.lit(False))), "parts"
    )
    train, held_out = parts.where("train").drop("train"), parts.where("NOT train").drop("train")
    rows = stored_table(
        rows.select(id_column, "feature", F.col("value").cast("double").alias("value")).join(
            parts.select(id_column, "train"), id_column, "left"
        ),
        "feature-rows",
    )
    dictionary = feature_dictionary(rows, F.col("train"))
    size = dictionary.count()
    common = majority_class(train, label)
    out = []
    for name, keep in feature_sets.items():
        chosen = dictionary if keep is None else dictionary.where(keep)
        entries = stored_table(
            scaled_entries(rows.where("train IS NOT NULL"), chosen, id_column, "train"), "entries"
        )
        vectors = sparse_vectors(entries.where("train"), id_column)
        fit_on = with_vectors(train.withColumn("label__y", F.col(label).cast("double")), vectors, id_column)
        fitted = _regression(l2).fit(ml_vectors(fit_on, size, "label__y", name="features__v"))
        weights = literal_table(
            spark, ["index", "weight"], [(i, float(w)) for i, w in enumerate(fitted.coefficients)] or [(-1, 0.0)]
        ).select(F.col("index").cast("int").alias("index"), "weight")
        coefficients = durable(
            chosen.join(weights, "index").select("feature", "index", F.col("weight").alias("coefficient"))
        )
        scores = sparse_scores(entries.where("NOT train"), weights, id_column, "score")
        chance = sigmoid(F.coalesce("score", F.lit(0.0)) + F.lit(float(fitted.intercept)))
        predictions = durable(
            held_out.join(scores, id_column, "left").withColumn("predicted_proba", chance).select(
                id_column, label, above_threshold(F.col("predicted_proba")).alias("predicted_class"), "predicted_proba"
            )
        )
        scored = [
            predictions.select(F.lit("model").alias("scored"), label, "predicted_class"),
            held_out.select(F.lit("baseline").alias("scored"), label, F.lit(common).alias("predicted_class")),
        ]
        metrics = classification_metrics(reduce(DataFrame.unionByName, scored), label, "predicted_class", by=("scored",))
        out.append(
            VectorExperiment(
                name, chosen.count(), coefficients, float(fitted.intercept),
                with_vectors(labels, sparse_vectors(entries.drop("train"), id_column), id_column).select(
                    id_column, label, F.to_json("indices").alias("indices"), F.to_json("values").alias("values")
                ),
                predictions, metrics,
            )
        )
    return out


def metrics_document(experiment: Experiment | VectorExperiment) -> DataFrame:
    """One nested row: baseline and model scores with the data set's size."""
    def scores(kind: str):
        row = F.struct(*METRICS)
        return F.max(F.when(F.col("scored") == kind, row)).alias(f"{kind}_metrics")

    size = experiment.dataset.count()
    return experiment.metrics.agg(scores("baseline"), scores("model")).select(
        F.lit(experiment.name).alias("experiment"),
        "baseline_metrics",
        "model_metrics",
        F.lit(size).cast("long").alias("dataset_rows"),
        F.lit(experiment.features_count).alias("features_count"),
    )


def comparison(experiments: Sequence[Experiment | VectorExperiment]) -> DataFrame:
    """One row per experiment: feature count and the headline scores."""
    rows = [
        e.metrics.where(F.col("scored") == "model").select(
            F.lit(e.name).alias("experiment"),
            F.lit(e.features_count).alias("features_count"),
            "accuracy", "balanced_accuracy", "f1",
        )
        for e in experiments
    ]
    return reduce(DataFrame.unionByName, rows)


def comparison_document(experiments: Sequence[Experiment | VectorExperiment]) -> DataFrame:
    """One row with the complete metrics of each experiment under its name."""
    rows = [
        metrics_document(e).select(F.struct("*").alias(e.name)) for e in experiments
    ]
    return reduce(DataFrame.crossJoin, rows)  # one row each


def ablation(
    dataset: DataFrame,
    feature_sets: Mapping[str, Sequence[str]],
    label: str,
    id_column: str,
    **options,
) -> list[Experiment]:
    """The same data set with several feature sets and one split, fitted once."""
    split = {k: options[k] for k in ("test", "seed") if k in options}
    cuts = class_cuts(dataset, label, id_column, **split)
    return [
        run_experiment(name, dataset, features, label, id_column, cuts=cuts, **options)
        for name, features in feature_sets.items()
    ]
