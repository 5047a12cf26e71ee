"""What each step of cleaning and splitting kept and removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surtido.constants import MIN_ACTIVE_DAYS
from surtido.operators.catalog import cutoff_of, day_masks, days_since
from surtido.operators.cleaning import COPIES, STEP, count_copies


def _as_rows(one_row: DataFrame, names: list[str], label: str) -> DataFrame:
    """One row per counter of a one-row DataFrame, numbered in the given order."""
    pairs = F.array(*[
        F.struct(F.lit(i).alias("orden"), F.lit(n).alias(label), F.col(n).cast("bigint").alias("filas"))
        for i, n in enumerate(names)
    ])
    return one_row.select(F.explode(pairs).alias("p")).select("p.*")


def cleaning_audit(lines: DataFrame) -> DataFrame:
    """Rows left after every cleaning step: ``orden, paso, filas``.

    ``lines`` are the written ones of :func:`~surtido.operators.cleaning.count_copies`, of which
    two columns are read and the raw input is not read again, or raw lines, which are counted.
    """
    counted = lines if STEP in lines.columns else count_copies(lines)

    def left(*dropped: int) -> Column:
        kept = F.when(~F.col(STEP).isin(*dropped), F.col(COPIES)) if dropped else F.col(COPIES)
        return F.coalesce(F.sum(kept), F.lit(0))

    counts = counted.agg(
        left().alias("inicio"), left(1).alias("sin_cancelaciones"),
        left(1, 2).alias("cantidad_positiva"), left(1, 2, 3).alias("precio_positivo"),
        F.count_if(F.col(STEP) == 0).alias("sin_duplicados"))
    return _as_rows(counts, counts.columns, "paso")


def split_audit(lines: DataFrame, min_days: int = MIN_ACTIVE_DAYS) -> DataFrame:
    """Products and rows kept and excluded by the activity filter: ``orden, medida, filas``.

    ``lines`` are the written active days of :func:`~surtido.operators.catalog.day_masks`, or
    clean lines, of which these are made. Products without any sale in the last month are dropped too, but the
    excluded count covers only those sold on too few days.
    """
    days = lines if "dias" in lines.columns else day_masks(lines)
    per_product = days.where(F.col("id_producto").isNotNull()).groupBy("id_producto").agg(
        F.sum("filas").alias("filas"), F.sum(days_since(cutoff_of(days))).alias("dias"))
    kept = F.col("dias") >= min_days
    counts = per_product.agg(
        F.count_if((F.col("dias") > 0) & ~kept).alias("productos_excluidos"),
        F.count_if(kept).alias("productos_unicos"),
        F.coalesce(F.sum("filas"), F.lit(0)).alias("filas_antes"),
        F.coalesce(F.sum(F.when(kept, F.col("filas"))), F.lit(0)).alias("filas_restantes"),
    )
    return _as_rows(counts, counts.columns, "medida")


def dataset_report(df: DataFrame) -> DataFrame:
    """Row and column counts of a loaded data set."""
    return df.agg(F.count(F.lit(1)).alias("filas")).withColumn("columnas", F.lit(len(df.columns)))
