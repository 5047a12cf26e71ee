"""Training: sales lines to models, backtest and forecast, for one series or many."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surtido.constants import MIN_MONTH_COVERAGE
from surtido.operators.features import prepared_series
from surtido.operators.forecast import forecast_next_year
from surtido.operators.ridge import backtest_metrics, fit_models
from surtido.operators.series import KEY, demand_series


class Training:
    """The results of training on ``series``; each one is planned when it is asked for."""

    def __init__(self, series: DataFrame):
        self.series = series

    @cached_property
    def prepared(self) -> DataFrame:
        """Capped, logged, with features."""
        return prepared_series(self.series)

    @cached_property
    def models(self) -> DataFrame:
        """One tuned model per series, fitted on all rows."""
        return fit_models(self.prepared)

    @cached_property
    def backtest(self) -> DataFrame:
        """Error metrics on the newest rows, by models that did not see them."""
        return backtest_metrics(self.prepared)

    @cached_property
    def forecast(self) -> DataFrame:
        """Months of the next year."""
        return forecast_next_year(self.models)

    @cached_property
    def too_short(self) -> DataFrame:
        """Series without enough months for a feature row."""
        return self.skipped.filter(F.col("meses") <= 3).drop("motivo")

    @cached_property
    def skipped(self) -> DataFrame:
        """Series that lack a result, with the reason: ``series_key, meses, motivo``.

        Three months go into the lags of a row, and the backtest takes at least one row.
        """
        months = self.series.groupBy(KEY).agg(F.count(F.lit(1)).alias("meses"))
        reason = F.when(F.col("meses") <= 3, "sin modelo").when(
            F.col("meses") == 4, "sin backtest")
        return months.withColumn("motivo", reason).filter(F.col("motivo").isNotNull())


def train(sales: DataFrame, keys: Sequence[str] = (),
          min_days: int = MIN_MONTH_COVERAGE) -> Training:
    """Train the one global series, or one per value of ``keys`` (say, ``["id_producto"]``)."""
    return Training(demand_series(sales, keys, min_days))
