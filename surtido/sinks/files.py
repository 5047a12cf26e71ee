"""File sinks: the clean set, the forecast and the model."""

from __future__ import annotations

from pyspark.sql import DataFrame

from surtido.operators.series import KEY


def write_clean(clean: DataFrame, warehouse: str, file_format: str = "parquet") -> str:
    """The whole clean set, before any product filter. Training reads it from here."""
    path = f"{warehouse}/ventas_limpias"
    writer = clean.write.mode("overwrite")
    if file_format == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(file_format).save(path)
    return path


def write_forecast_csv(forecast: DataFrame, path: str) -> None:
    """``fecha, ventas_reales, ventas_predichas``, with the series key where there are many."""
    columns = ["fecha", "ventas_reales", "ventas_predichas"]
    forecast.select(KEY, *columns).write.mode("overwrite").option("header", True).csv(path)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_days(days: DataFrame, warehouse: str) -> DataFrame:
    """Active days per product and month as bits; returns the written table."""
    return _written(days, f"{warehouse}/dias_activos")


def write_valid(valid: DataFrame, warehouse: str) -> DataFrame:
    """Valid products as a table of their own; returns the written table."""
    return _written(valid, f"{warehouse}/productos_validos")


def write_series(series: DataFrame, warehouse: str) -> DataFrame:
    """Monthly series as a table of their own; returns the written table."""
    return _written(series, f"{warehouse}/serie_mensual")


def write_metrics(metrics: DataFrame, warehouse: str) -> str:
    """Backtest metrics, one row per series."""
    path = f"{warehouse}/metricas"
    metrics.write.mode("overwrite").parquet(path)
    return path


def write_model(models: DataFrame, warehouse: str) -> str:
    """Coefficients and scalers as a table, one row per series."""
    path = f"{warehouse}/modelo"
    models.write.mode("overwrite").parquet(path)
    return path
