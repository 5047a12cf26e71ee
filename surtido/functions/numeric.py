"""Numeric column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(c: Column) -> Column:
    """NaN as null. Spark sorts NaN above every number, so ``NaN > 0`` holds there."""
    return F.when(~F.isnan(c), c)


def round_half_even(c: Column, digits: int = 0) -> Column:
    """Round the double itself, ties to even: 0.125 gives 0.12 and 1.005 gives 1.0."""
    if digits == 0:
        return F.rint(c)
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def money_round(c: Column) -> Column:
    return round_half_even(c, 2)


def clip(c: Column, low=None, high=None) -> Column:
    """Bound a value on one or both sides; null stays null.

    ``greatest`` and ``least`` skip nulls, hence the guard.
    """
    bounded = c
    if high is not None:
        bounded = F.least(high if isinstance(high, Column) else F.lit(high), bounded)
    if low is not None:
        bounded = F.greatest(low if isinstance(low, Column) else F.lit(low), bounded)
    return F.when(c.isNotNull(), bounded)


def adjusted_skewness(c: Column) -> Column:
    """Bias-adjusted skewness (an aggregate); null below three values.

    ``skewness`` alone is the population form.
    """
    n = F.count(c).cast("double")
    return F.when(
        F.count(c) >= 3,
        F.when(F.var_pop(c) == 0, F.lit(0.0)).otherwise(
            F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2)
        ),
    )


def r2_score(n: Column, residual: Column, total: Column) -> Column:
    """R2 from the row count, the residual and the total sum of squares.

    Without spread in the actual values an exact fit scores 1 and any other 0; below two
    rows there is no score.
    """
    return F.when(
        n >= 2,
        F.when(total > 0, 1 - residual / total)
        .when(residual == 0, F.lit(1.0))
        .otherwise(F.lit(0.0)),
    )
