"""The global forecast spread over the products by their share of past units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surtido.functions import round_half_even
from surtido.schemas import CONFIDENCE

FORECAST_COLUMNS = (
    "id_producto", "fecha_prediccion", "unidades_predichas", "unidades_vendidas",
    "confianza_modelo",
)


def product_shares(ventas: DataFrame) -> DataFrame:
    """Units and share of all units per product; the total is a scalar subquery."""
    units = ventas.groupBy("id_producto").agg(F.sum("unidades_vendidas").alias("unidades"))
    units = units.filter(F.col("id_producto").isNotNull())
    total = units.agg(F.sum("unidades")).scalar()
    return units.withColumn("cuota", F.col("unidades").cast("double") / total.cast("double"))


def forecast_months(forecast: DataFrame) -> Column:
    """The global forecast as one sorted array: twelve months, whatever the data size."""
    month = F.struct("fecha", "ventas_predichas", "ventas_reales")
    return forecast.agg(F.array_sort(F.collect_list(month))).scalar()


def allocate(forecast: DataFrame, shares: DataFrame, confidence: Column) -> DataFrame:
    """One row per product and month: share times forecast, whole units (ties to even).

    ``forecast`` is the one global series. Its months reach the products as a single
    array value, so there is no join. ``explode_outer`` keeps the optimizer from
    repeating that value in a row filter.
    """
    part = F.col("m")
    share = F.col("cuota")
    months = shares.select("id_producto", "cuota", forecast_months(forecast).alias("meses"))
    return (
        months.select("id_producto", "cuota", F.explode_outer("meses").alias("m"))
        .filter(part.isNotNull())
        .select(
            "id_producto",
            part["fecha"].alias("fecha_prediccion"),
            round_half_even(part["ventas_predichas"] * share).alias("unidades_predichas"),
            round_half_even(part["ventas_reales"] * share).alias("unidades_vendidas"),
            confidence.cast("double").alias("confianza_modelo"),
        )
    )


def global_rows(forecast: DataFrame, confidence: Column) -> DataFrame:
    """The global forecast itself, as forecast rows without a product."""
    return forecast.select(
        F.lit(None).cast("string").alias("id_producto"),
        F.col("fecha").alias("fecha_prediccion"),
        round_half_even(F.col("ventas_predichas")).alias("unidades_predichas"),
        round_half_even(F.col("ventas_reales")).alias("unidades_vendidas"),
        confidence.cast("double").alias("confianza_modelo"),
    )


def to_forecast_rows(allocated: DataFrame) -> DataFrame:
    """Stored types: units rounded to whole numbers, missing confidence kept missing."""
    return allocated.select(
        "id_producto",
        F.col("fecha_prediccion").cast("date").alias("fecha_prediccion"),
        round_half_even(F.col("unidades_predichas")).cast("bigint").alias("unidades_predichas"),
        round_half_even(F.col("unidades_vendidas")).cast("bigint").alias("unidades_vendidas"),
        F.col("confianza_modelo").cast(CONFIDENCE).alias("confianza_modelo"),
    )
