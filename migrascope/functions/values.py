"""Numeric expressions with one policy: an undefined ratio is NULL, never inf or NaN."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITIES = (float("inf"), float("-inf"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator; NULL where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def per_thousand(count: Column, population: Column) -> Column:
    return ratio(count, population) * F.lit(1000.0)


def null_skipping_sum(columns: Iterable[Column]) -> Column:
    """Row sum in which a NULL adds nothing (all NULL gives 0)."""
    total = F.lit(0)
    for column in columns:
        total = total + F.coalesce(column, F.lit(0))
    return total


def count_positive(columns: Iterable[Column]) -> Column:
    total = F.lit(0)
    for column in columns:
        total = total + F.when(column > 0, 1).otherwise(0)
    return total


def finite_or_zero(column: Column) -> Column:
    """NULL, NaN and both infinities become 0."""
    value = column.cast("double")
    usable = value.isNotNull() & ~F.isnan(value) & ~value.isin(*INFINITIES)
    return F.when(usable, value).otherwise(F.lit(0.0))


def number_or_zero(text: Column) -> Column:
    """Text to double; anything unreadable counts as 0."""
    return F.coalesce(F.trim(text.cast("string")).try_cast("double"), F.lit(0.0))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.when(condition, 1).otherwise(0)


def clip(column: Column, low: float, high: float) -> Column:
    return F.when(column.isNotNull(), F.least(F.greatest(column, F.lit(low)), F.lit(high)))
