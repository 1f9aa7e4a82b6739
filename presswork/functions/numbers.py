"""Small numeric expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def round_even(value: Column, digits: int) -> Column:
    """Round half to even."""
    scale = 10.0**digits
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def sigmoid(value: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-value))


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom as double, 0 where the divisor is 0."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top.cast("double") / bottom)


def first_argmax(values: Column) -> Column:
    """0-based position of the largest element; the first one wins a tie."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def dot(left: Column, right: Column) -> Column:
    """Inner product of two arrays of equal length."""
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
