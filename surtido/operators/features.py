"""Model features of a monthly series.

All window features look at earlier rows only. They are positional: a month that the
coverage filter removed is bridged, not counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surtido.constants import FEATURES, ROLLING_ROWS, TARGET, TEST_RATIO
from surtido.operators.series import (
    KEY, by_date, cap_outliers, log_series, whole_series,
)


def calendar_columns(date: Column) -> dict[str, Column]:
    """Month, quarter and the month as a point on a circle."""
    angle = 2 * F.pi() * F.month(date) / F.lit(12.0)
    return {
        "mes": F.month(date),
        "trimestre": F.quarter(date),
        "mes_sin": F.sin(angle),
        "mes_cos": F.cos(angle),
    }


def lag_columns() -> dict[str, Column]:
    lags = {f"lag_{k}": F.lag(TARGET, k).over(by_date()) for k in (1, 2, 3)}
    return lags | {"diff_1": F.lag(TARGET, 1).over(by_date()) - F.lag(TARGET, 2).over(by_date())}


def rolling_columns() -> dict[str, Column]:
    """Mean and sample deviation of the previous rows, null until all of them exist."""
    previous = by_date().rowsBetween(-ROLLING_ROWS, -1)
    full = F.count(TARGET).over(previous) == ROLLING_ROWS
    return {
        "media_3": F.when(full, F.avg(TARGET).over(previous)),
        "std_3": F.when(full, F.stddev_samp(TARGET).over(previous)),
    }


def with_features(series: DataFrame) -> DataFrame:
    """The series with its feature columns; the first rows lack history and hold nulls."""
    trend = {"tendencia": F.row_number().over(by_date()) - 1}
    return series.withColumns(
        lag_columns() | rolling_columns() | trend | calendar_columns(F.col("fecha")))


def feature_matrix(series: DataFrame) -> DataFrame:
    """Rows with a value in every feature."""
    return with_features(series).dropna(subset=[*FEATURES, TARGET])


def prepared_series(series: DataFrame) -> DataFrame:
    """Cap outliers, take logs, build features. The fences use the whole series."""
    return feature_matrix(log_series(cap_outliers(series)))


def with_position(rows: DataFrame) -> DataFrame:
    """Position of a row in its series (``fila``, from 0) and the series length (``n``)."""
    return rows.withColumns({
        "fila": F.row_number().over(by_date()) - 1,
        "n": F.count(F.lit(1)).over(whole_series()).cast("int"),
    })


def time_split(rows: DataFrame, ratio: float = TEST_RATIO) -> DataFrame:
    """Flag the newest rows of every series as test rows, at least one."""
    placed = with_position(rows)
    n_test = F.greatest(F.lit(1), F.rint(F.col("n") * F.lit(ratio)).cast("int"))
    return placed.withColumn(
        "parte", F.when(F.col("fila") >= F.col("n") - n_test, "test").otherwise("train"))


# Smallest relative step of a double; bounds the rounding noise of a constant column.
EPSILON = 2.0 ** -52

# The wide expressions below are written as SQL text: one call each to build them.
OVER_SERIES = (
    f"over (partition by {KEY} order by fecha "
    "rows between unbounded preceding and unbounded following)"
)


def scaling(rows: DataFrame, columns=FEATURES) -> DataFrame:
    """Attach ``media`` and ``escala``: mean and population deviation of each column.

    A column without spread, up to rounding noise, gets scale 1.
    """
    means = [f"avg(cast({c} as double)) {OVER_SERIES}" for c in columns]
    variances = [f"var_pop(cast({c} as double)) {OVER_SERIES}" for c in columns]
    measured = rows.withColumns({
        "media": F.expr(f"array({', '.join(means)})"),
        "_varianza": F.expr(f"array({', '.join(variances)})"),
        "_n": F.expr(f"count(1) {OVER_SERIES}"),
    })
    scale = f"""zip_with(_varianza, media, (v, m) ->
        if(v <= _n * {EPSILON!r}D * v + pow(_n * m * {EPSILON!r}D, 2), 1D, sqrt(v)))"""
    return measured.withColumn("escala", F.expr(scale)).drop("_varianza", "_n")


def with_scaled(rows: DataFrame, columns=FEATURES) -> DataFrame:
    """``x``: the features as one array, scaled by ``media`` and ``escala``."""
    scaled = [f"(cast({c} as double) - media[{i}]) / escala[{i}]" for i, c in enumerate(columns)]
    return rows.withColumn("x", F.expr(f"array({', '.join(scaled)})"))


def scaled_features(rows: DataFrame, columns=FEATURES) -> DataFrame:
    return with_scaled(scaling(rows, columns), columns)
