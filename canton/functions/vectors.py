"""Expressions for linear scoring."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from canton.functions.text import sql_double, sql_name

# Fixed value: scores are clamped to this range before the exponential.
SIGMOID_LIMIT = 50.0


def sigmoid(c: Column) -> Column:
    bounded = F.greatest(F.lit(-SIGMOID_LIMIT), F.least(F.lit(SIGMOID_LIMIT), c))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-bounded))


def dot(a: Column, b: Column) -> Column:
    """Dot product of two ``array<double>`` columns."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, v: total + v
    )


def weighted_sum(columns: list[str], weights: list[float]) -> Column:
    """Dot product with constant weights over scalar columns.

    The sum is built as a balanced tree, so wide models keep a shallow
    expression that whole-stage codegen can compile.
    """
    terms = [f"{sql_name(c)} * {sql_double(w)}" for c, w in zip(columns, weights, strict=True)]
    while len(terms) > 1:
        paired = [f"({a} + {b})" for a, b in zip(terms[::2], terms[1::2])]
        terms = paired + terms[len(paired) * 2:]
    return F.expr(terms[0] if terms else "0D")


def above_threshold(p: Column, threshold: float = 0.5) -> Column:
    return (p >= threshold).cast("int")
