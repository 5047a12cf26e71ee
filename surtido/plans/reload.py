"""The full reload: one invoice file or folder to stored tables and forecasts."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surtido.constants import DATE_FORMATS, MIN_ACTIVE_DAYS, MIN_MONTH_COVERAGE
from surtido.operators.allocation import allocate, global_rows, product_shares
from surtido.operators.audit import cleaning_audit, split_audit
from surtido.operators.catalog import day_masks, split_tables, valid_products
from surtido.operators.cleaning import count_copies, normalize_lines
from surtido.operators.forecast import forecast_next_year
from surtido.operators.ridge import confidence, error_metrics
from surtido.operators.series import demand_series
from surtido.plans.training import Training
from surtido.session import SETTINGS, ensure_checkpoint_dir, remove_folder
from surtido.sinks import (
    append_forecasts, append_sales, clear_tables, insert_ignore, write_clean, write_days,
    write_forecast_csv, write_metrics, write_model, write_series, write_valid,
)
from surtido.sources import load_dataset, read_clean, read_metrics, read_model, read_stored
from surtido.versions import current, new_version, publish, remove_old


def store_clean(raw: DataFrame, warehouse: str) -> DataFrame:
    """Clean and write the lines, and go on from the written table.

    The table cuts the lineage: the later steps scan its columns instead of repeating
    duplicate removal, and it is kept when one of them fails. It holds the counts of the
    audit as well, so the raw input is read once.
    """
    write_clean(normalize_lines(count_copies(raw)), warehouse)
    return read_clean(raw.sparkSession, warehouse)


def store_tables(clean: DataFrame, warehouse: str, min_days: int = MIN_ACTIVE_DAYS) -> DataFrame:
    """Split the clean lines and reload productos and ventas; returns the active days.

    The active days are written first, and the valid products from them: both tables filter
    by these, and the size of the file tells the planner how to join.
    """
    days = write_days(day_masks(clean), warehouse)
    valid = write_valid(valid_products(min_days=min_days, days=days), warehouse)
    productos, ventas = split_tables(clean, min_days, valid)
    clear_tables(clean.sparkSession, warehouse)
    insert_ignore(productos, warehouse)
    append_sales(ventas, warehouse)
    return days


def store_audit(days: DataFrame, warehouse: str, min_days: int = MIN_ACTIVE_DAYS) -> None:
    """What the steps kept and removed, as a table: ``orden, paso, filas``.

    It is summed from the written lines and active days.
    """
    counted = days.sparkSession.read.parquet(f"{warehouse}/ventas_limpias")
    split = split_audit(days, min_days).select(
        (F.col("orden") + 5).alias("orden"), F.col("medida").alias("paso"), "filas")
    cleaning_audit(counted).unionByName(split).write.mode("overwrite").parquet(
        f"{warehouse}/auditoria")


def store_forecasts(clean: DataFrame, warehouse: str, *, min_coverage: int = MIN_MONTH_COVERAGE,
                    placeholder_confidence: bool = False) -> None:
    """Train on all clean lines, spread the forecast over the stored products, store it.

    The monthly series is written first: models and backtest start at its few rows instead
    of aggregating all sales again.
    The confidence is the R2 of the backtest. ``placeholder_confidence`` scores the
    forecast against itself instead, which is 1 by construction.
    """
    spark = clean.sparkSession
    training = Training(write_series(demand_series(clean, min_days=min_coverage), warehouse))
    write_model(training.models, warehouse)
    forecast = forecast_next_year(read_model(spark, warehouse))
    write_forecast_csv(forecast, f"{warehouse}/predicciones_ridge")
    write_metrics(training.backtest, warehouse)
    scored = error_metrics(forecast) if placeholder_confidence else read_metrics(spark, warehouse)
    score = confidence(scored).select("confianza").scalar()
    shares = product_shares(read_stored(spark, warehouse, "ventas"))
    rows = allocate(forecast, shares, score).unionByName(global_rows(forecast, score))
    append_forecasts(rows, warehouse)


def reload(spark: SparkSession, path: str | Sequence[str], warehouse: str, *, min_days: int = MIN_ACTIVE_DAYS,
           min_coverage: int = MIN_MONTH_COVERAGE, placeholder_confidence: bool = False,
           multi_line: bool = False, file_format: str | None = None,
           infer_dates: bool = False, audit: bool = True) -> None:
    """Load, clean, split, store, train, forecast and store again.

    Stores ventas_limpias, auditoria, dias_activos, productos, ventas, ultimas_ventas,
    predicciones, productos_validos, serie_mensual, modelo, metricas and predicciones_ridge.
    Several files are one data set. All of them are written as a new version of ``warehouse``
    that nobody reads, and published together at the end: wherever the job fails, readers have
    all the old tables or all the new ones.
    """
    ensure_checkpoint_dir(spark)  # settings that are missing stop the job before it works
    version = new_version(warehouse)
    try:
        raw = load_dataset(spark, path, multi_line=multi_line, file_format=file_format,
                           formats=None if infer_dates else DATE_FORMATS)
        clean = store_clean(raw, version)
        days = store_tables(clean, version, min_days)
        if audit:
            store_audit(days, version, min_days)
        store_forecasts(clean, version, min_coverage=min_coverage,
                        placeholder_confidence=placeholder_confidence)
        publish(spark, warehouse, version)
    except BaseException:
        if current(spark, warehouse) != version:
            remove_folder(spark, version)
        raise
    remove_old(spark, warehouse)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Reload the retail tables from an invoice file.")
    parser.add_argument("--input", required=True, help="CSV, XLSX or parquet file or folder")
    parser.add_argument("--warehouse", required=True, help="folder of the stored tables")
    parser.add_argument("--format", help="format of a folder whose name has no extension")
    parser.add_argument("--multi-line", action="store_true",
                        help="the CSV has line breaks inside quotes")
    parser.add_argument("--infer-dates", action="store_true",
                        help="infer the formats of date texts from all of them")
    options = parser.parse_args(arguments)
    builder = SparkSession.builder.appName("surtido-reload")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    reload(spark, options.input, options.warehouse, multi_line=options.multi_line,
           file_format=options.format, infer_dates=options.infer_dates)


if __name__ == "__main__":
    main()
