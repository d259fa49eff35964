"""Scores of a binary classifier from one pass over (truth, prediction)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

METRICS = (
    "accuracy", "balanced_accuracy", "precision", "recall", "specificity", "f1",
    "tp", "tn", "fp", "fn",
)


def _share(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _scores(tp: Column, tn: Column, fp: Column, fn: Column) -> list[Column]:
    precision, recall = _share(tp, tp + fp), _share(tp, tp + fn)
    specificity = _share(tn, tn + fp)
    values = {
        "accuracy": _share(tp + tn, tp + tn + fp + fn),
        "balanced_accuracy": (recall + specificity) / 2,
        "precision": precision,
        "recall": recall,
        "specificity": specificity,
        "f1": _share(2 * precision * recall, precision + recall),
        "tp": tp, "tn": tn, "fp": fp, "fn": fn,
    }
    return [values[m].alias(m) for m in METRICS]


def classification_metrics(
    df: DataFrame, truth: str, prediction: str, by: tuple[str, ...] = ()
) -> DataFrame:
    """Confusion counts and scores, 0.0 where a score is undefined."""
    y, p = F.col(truth), F.col(prediction)
    counts = df.groupBy(*by).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )
    return counts.select(*by, *_scores(*[F.col(c) for c in ("tp", "tn", "fp", "fn")]))


def majority(label: str) -> Column:
    """Aggregate: the more frequent of 0 and 1; an exact draw gives 0."""
    return F.rint(F.avg(label)).cast("int")


def majority_class(train: DataFrame, label: str) -> int:
    return train.agg(majority(label)).first()[0]
