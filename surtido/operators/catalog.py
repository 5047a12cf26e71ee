"""Split of clean lines into the product catalogue and the sales facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surtido.constants import DEFAULT_CATEGORY, MIN_ACTIVE_DAYS
from surtido.functions import month_start
from surtido.schemas import VENTAS

# The stored columns but the key, which the sink adds.
FACT_COLUMNS = tuple(field.name for field in VENTAS if field.name != "id_venta")


def recent_cutoff(clean: DataFrame) -> Column:
    """First day of the last calendar month, counted back from the newest sale.

    A scalar subquery: one value, computed once, no join.
    """
    return clean.agg(F.add_months(F.max("fecha_venta"), -1)).scalar()


def last_month_lines(clean: DataFrame) -> DataFrame:
    return clean.filter(F.col("fecha_venta") >= recent_cutoff(clean))


def day_masks(clean: DataFrame) -> DataFrame:
    """The active days of every product and month as bits: ``id_producto, mes, dias, filas``.

    Bit 0 of ``dias`` is the first of the month; ``filas`` counts the lines. Masks of parts of
    the lines are merged by ``bit_or``, in the tasks before the shuffle as well, so a hot
    product sends one row per month and task. A mask takes four bytes; everything that is
    asked about active days is answered from this table without the lines. Copies of lines
    change nothing but ``filas``.
    """
    bit = F.call_function("shiftleft", F.lit(1), F.dayofmonth("fecha_venta") - 1)
    return clean.groupBy("id_producto", month_start(F.col("fecha_venta")).alias("mes")).agg(
        F.bit_or(bit).alias("dias"), F.count(F.lit(1)).alias("filas"))


def cutoff_of(days: DataFrame) -> Column:
    """:func:`recent_cutoff` from day masks: the highest bit of a mask is its newest day."""
    newest = F.date_add("mes", F.length(F.bin("dias")) - 1)
    return days.agg(F.add_months(F.max(newest), -1)).scalar()


def days_since(first: Column) -> Column:
    """How many days of a mask, from ``first`` on."""
    whole, part = F.bit_count("dias"), F.bit_count(
        F.call_function("shiftrightunsigned", F.col("dias"), F.dayofmonth(first) - 1))
    month = month_start(first)
    return F.coalesce(F.when(F.col("mes") > month, whole).when(
        F.col("mes") == month, part), F.lit(0))


def active_days(clean: DataFrame | None = None, days: DataFrame | None = None) -> DataFrame:
    """Distinct sale days per product in the last month.

    From the day masks, ``days`` where they are written already, else those of the lines.
    """
    days = day_masks(clean) if days is None else days
    counts = days.groupBy("id_producto").agg(
        F.sum(days_since(cutoff_of(days))).alias("dias_vendido"))
    return counts.filter(F.col("dias_vendido") > 0)


def valid_products(clean: DataFrame | None = None, min_days: int = MIN_ACTIVE_DAYS,
                   days: DataFrame | None = None) -> DataFrame:
    return active_days(clean, days).filter(F.col("dias_vendido") >= min_days)


def keep_valid(clean: DataFrame, min_days: int = MIN_ACTIVE_DAYS,
               valid: DataFrame | None = None) -> DataFrame:
    """All lines, of any date, of the valid products (``valid``, where already at hand).

    No broadcast hint: the catalogue grows with the data, so the join is chosen from its
    measured size, and a hot product is split by the skew-join rule.
    """
    if valid is None:
        valid = valid_products(clean, min_days)
    return clean.join(valid.select("id_producto"), "id_producto", "left_semi")


def top_price_catalog(lines: DataFrame) -> DataFrame:
    """One row per product: the name sold at the highest price (ties: first name).

    The top price per (product, name) is a plain aggregate, partial before the shuffle;
    the ranking then sees one row per name and product instead of all lines.
    """
    prices = lines.groupBy("id_producto", "nombre").agg(
        F.max("precio_unitario").alias("precio_unitario"))
    order = Window.partitionBy("id_producto").orderBy(
        F.desc("precio_unitario"), F.asc_nulls_last("nombre"))
    return (
        prices.withColumn("puesto", F.row_number().over(order))
        .filter(F.col("puesto") == 1)
        .select("id_producto", "nombre", F.lit(DEFAULT_CATEGORY).alias("categoria"),
                "precio_unitario")
    )


def sales_fact(lines: DataFrame) -> DataFrame:
    return lines.select(*FACT_COLUMNS)


def split_tables(clean: DataFrame, min_days: int = MIN_ACTIVE_DAYS,
                 valid: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(catalogue, facts) of the products sold on enough days of the last month."""
    kept = keep_valid(clean, min_days, valid)
    return top_price_catalog(kept), sales_fact(kept)
