"""Recursive forecast of the months up to the end of the next year.

Each step feeds its own result to the next one, so a series is folded over its months
with ``aggregate``: a built-in expression on one row per series, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surtido.constants import FEATURES
from surtido.functions import months_to_end_of_next_year
from surtido.operators.features import calendar_columns
from surtido.operators.series import KEY


def step_features(state: Column, date: Column) -> dict[str, Column]:
    """Features of one future month from the three newest values (h1 is the newest)."""
    h1, h2, h3 = state["h1"], state["h2"], state["h3"]
    mean = (h1 + h2 + h3) / F.lit(3.0)
    squares = (h1 - mean) * (h1 - mean) + (h2 - mean) * (h2 - mean) + (h3 - mean) * (h3 - mean)
    return {
        "lag_1": h1,
        "lag_2": h2,
        "lag_3": h3,
        "media_3": mean,
        "std_3": F.sqrt(squares / F.lit(2.0)),
        "diff_1": h1 - h2,
        "tendencia": state["tendencia"],
    } | calendar_columns(date)


def _step(state: Column, date: Column) -> Column:
    features = step_features(state, date)
    value = F.col("intercepto")
    for i, name in enumerate(FEATURES):
        scaled = (features[name].cast("double") - F.col("media")[i]) / F.col("escala")[i]
        value = value + scaled * F.col("coef")[i]
    value = F.greatest(F.lit(0.0), value)
    return F.struct(
        value.alias("h1"), state["h1"].alias("h2"), state["h2"].alias("h3"),
        (state["tendencia"] + 1).alias("tendencia"),
        F.concat(state["pasos"], F.array(F.struct(date.alias("fecha"), value.alias("valor"))))
        .alias("pasos"),
    )


def recursive_steps(models: DataFrame) -> DataFrame:
    """Predicted log value of every month after the end of each series.

    ``models`` needs the columns of ``fit_models``.
    """
    start = F.struct(
        "h1", "h2", "h3", (F.col("tendencia_fin") + 1).alias("tendencia"),
        F.expr("cast(array() as array<struct<fecha: date, valor: double>>)").alias("pasos"),
    )
    folded = F.aggregate(months_to_end_of_next_year(F.col("ultima")), start, _step,
                         lambda state: state["pasos"])
    return models.select(
        KEY, F.year("ultima").alias("ultimo_ano"), F.explode(folded).alias("paso"),
    ).select(KEY, "ultimo_ano", "paso.fecha", F.col("paso.valor").alias("prediccion"))


def forecast_next_year(models: DataFrame) -> DataFrame:
    """The 12 months of the year after the last month of data, in units.

    There are no actual values yet, so ``ventas_reales`` repeats the prediction.
    """
    steps = recursive_steps(models).filter(F.year("fecha") == F.col("ultimo_ano") + 1)
    units = F.expm1("prediccion")
    return steps.select(KEY, "fecha", units.alias("ventas_reales"), units.alias("ventas_predichas"))


def incomplete_forecasts(forecast: DataFrame, months: int = 12) -> DataFrame:
    """Series whose forecast does not have the expected number of months."""
    counts = forecast.groupBy(KEY).agg(F.count(F.lit(1)).alias("meses"))
    return counts.filter(F.col("meses") != months)
