"""Demand series: daily and monthly units, coverage, outliers, log scale.

A series is named by ``series_key``: the constant ``global``, or the values of the given
key columns. Whatever the size of the sales table, a series has one row per calendar day
or month after the first aggregation, so ordering inside a series is a small sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from surtido.constants import FENCE_WIDTH, GLOBAL_SERIES, MIN_MONTH_COVERAGE, TARGET
from surtido.functions import adjusted_skewness, clip, month_start

KEY = "series_key"


def by_date() -> WindowSpec:
    return Window.partitionBy(KEY).orderBy("fecha")


def whole_series() -> WindowSpec:
    """Every row of the series, in the same order as ``by_date`` so that one sort serves both."""
    return by_date().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def series_key(keys: Sequence[str] = ()) -> Column:
    if not keys:
        return F.lit(GLOBAL_SERIES)
    return F.concat_ws("|", *[F.col(k).cast("string") for k in keys])


def daily_units(sales: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Units per series and sale day: ``series_key, fecha, ventas``."""
    return (
        sales.filter(F.col("fecha_venta").isNotNull())
        .groupBy(series_key(keys).alias(KEY), F.col("fecha_venta").alias("fecha"))
        .agg(F.sum("unidades_vendidas").alias(TARGET))
    )


def monthly_units(sales: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Units and number of sale days per series and month with sales.

    Both come out of one aggregate over the daily units.
    """
    daily = daily_units(sales, keys)
    return daily.groupBy(KEY, month_start(F.col("fecha")).alias("fecha")).agg(
        F.sum(TARGET).alias(TARGET), F.count(F.lit(1)).alias("dias"))


def fill_months(monthly: DataFrame) -> DataFrame:
    """The series with its empty months: 0 units on 0 days.

    Every month also emits the empty ones up to the next month with sales.
    """
    upto = F.coalesce(F.add_months(F.lead("fecha").over(by_date()), -1), F.col("fecha"))
    months = monthly.withColumn("hasta", upto).withColumn(
        "mes_serie", F.explode(F.sequence("fecha", "hasta", F.expr("interval 1 month"))))
    own = F.col("mes_serie") == F.col("fecha")
    return months.select(
        KEY,
        F.col("mes_serie").alias("fecha"),
        F.when(own, F.col(TARGET)).otherwise(F.lit(0)).alias(TARGET),
        F.when(own, F.col("dias")).otherwise(F.lit(0)).alias("dias"),
    )


def covered_months(monthly: DataFrame, min_days: int = MIN_MONTH_COVERAGE) -> DataFrame:
    return monthly.filter(F.col("dias") >= min_days)


def demand_series(sales: DataFrame, keys: Sequence[str] = (),
                  min_days: int = MIN_MONTH_COVERAGE) -> DataFrame:
    """Monthly series that models are trained on: ``series_key, fecha, ventas`` (double)."""
    covered = covered_months(monthly_units(sales, keys), min_days)
    return covered.select(KEY, "fecha", F.col(TARGET).cast("double").alias(TARGET))


def series_report(series: DataFrame) -> DataFrame:
    return series.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("meses"),
        F.min("fecha").alias("primera"),
        F.max("fecha").alias("ultima"),
    )


def with_fences(series: DataFrame, width: float = FENCE_WIDTH) -> DataFrame:
    """Quartiles (linear interpolation) and outlier fences of every series."""
    quartiles = F.percentile(F.col(TARGET), F.array(F.lit(0.25), F.lit(0.75))).over(whole_series())
    q1, q3 = F.col("cuartiles")[0], F.col("cuartiles")[1]
    return (
        series.withColumn("cuartiles", quartiles)
        .withColumns({
            "q1": q1,
            "q3": q3,
            "limite_bajo": q1 - F.lit(width) * (q3 - q1),
            "limite_alto": q3 + F.lit(width) * (q3 - q1),
        })
        .drop("cuartiles")
    )


def iqr_fences(series: DataFrame, width: float = FENCE_WIDTH) -> DataFrame:
    """One row per series: quartiles, fences and the number of rows outside."""
    flagged = outlier_flags(series, width)
    return flagged.groupBy(KEY, "q1", "q3", "limite_bajo", "limite_alto").agg(
        F.count_if("atipico").alias("detectados"))


def outlier_flags(series: DataFrame, width: float = FENCE_WIDTH) -> DataFrame:
    outside = (F.col(TARGET) < F.col("limite_bajo")) | (F.col(TARGET) > F.col("limite_alto"))
    return with_fences(series, width).withColumn("atipico", outside)


def cap_outliers(series: DataFrame, width: float = FENCE_WIDTH) -> DataFrame:
    fenced = with_fences(series, width)
    capped = clip(F.col(TARGET), F.col("limite_bajo"), F.col("limite_alto"))
    return fenced.withColumn(TARGET, capped).drop("q1", "q3", "limite_bajo", "limite_alto")


def log_series(series: DataFrame) -> DataFrame:
    return series.withColumn(TARGET, F.log1p(TARGET))


def skew_report(series: DataFrame) -> DataFrame:
    """Skewness of every series before and after the log."""
    return series.groupBy(KEY).agg(
        adjusted_skewness(F.col(TARGET)).alias("asimetria"),
        adjusted_skewness(F.log1p(TARGET)).alias("asimetria_log"),
    )
