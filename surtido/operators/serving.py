"""Read queries over the stored tables.

Every per-product query answers for all products at once; ``product`` narrows it to one
and reaches the scan as a pushed-down filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surtido.constants import (
    LABEL_NAME_LENGTH, NO_CONFIDENCE_TEXT, RECENT_DAYS,
)
from surtido.functions import month_start


def only_product(df: DataFrame, product: str | None) -> DataFrame:
    return df if product is None else df.filter(F.col("id_producto") == product)


def _parallel_lists(df: DataFrame, key: str | None, date: str, **values: Column) -> DataFrame:
    """One row per key with parallel lists ordered by date.

    Only for results with few rows per key: the days of a month, the months of a year.
    """
    point = F.struct(F.col(date).alias("f"), *[c.alias(n) for n, c in values.items()])
    grouped = df.groupBy(key) if key else df.groupBy()
    points = grouped.agg(F.array_sort(F.collect_list(point)).alias("p"))
    lists = [F.transform("p", lambda x: F.date_format(x["f"], "yyyy-MM-dd")).alias("fechas")]
    lists += [F.col("p")[name].alias(name) for name in values]
    return points.select(*([key] if key else []), *lists)


def kpis(ventas: DataFrame, productos: DataFrame) -> DataFrame:
    """Total sales, total units and number of products; zeros on empty tables."""
    products = productos.agg(F.count(F.lit(1))).scalar()
    return ventas.agg(
        F.coalesce(F.sum(F.col("total_venta").cast("decimal(10,2)")).cast("decimal(20,2)"),
                   F.lit(0).cast("decimal(20,2)")).alias("ventas_totales"),
        F.coalesce(F.sum("unidades_vendidas"), F.lit(0)).cast("bigint").alias("unidades_totales"),
    ).withColumn("productos_distintos", products.cast("bigint"))


def product_list(productos: DataFrame, limit: int | None = None) -> DataFrame:
    """Products by name; with ``limit`` the first ones, a top-k per task, merged once."""
    listed = productos.select("id_producto", "nombre").orderBy("nombre", "id_producto")
    return listed if limit is None else listed.limit(limit)


def product_labels(products: DataFrame, length: int = LABEL_NAME_LENGTH) -> DataFrame:
    """A label per product: its code and the first ``length`` signs of its name."""
    name = F.substring("nombre", 1, length)
    return products.select("id_producto", "nombre",
                           F.concat_ws(" — ", "id_producto", name).alias("etiqueta"))


def daily_sales(ventas: DataFrame, product: str | None = None) -> DataFrame:
    """Units per product and day."""
    return only_product(ventas, product).groupBy("id_producto", "fecha_venta").agg(
        F.sum("unidades_vendidas").alias("unidades"))


def recent_sales(ventas: DataFrame, product: str | None = None,
                 days: int = RECENT_DAYS) -> DataFrame:
    """Daily units of the days before each product's own newest sale, both ends included.

    The newest day is taken over the daily totals, which have one row per calendar day
    even for a product that holds most of the sales.
    """
    newest = F.max("fecha_venta").over(Window.partitionBy("id_producto"))
    daily = daily_sales(ventas, product).withColumn("ultima", newest)
    recent = F.col("fecha_venta") >= F.date_sub("ultima", days)
    return daily.filter(recent).select("id_producto", "fecha_venta", "unidades")


def recent_sales_sql(ventas: DataFrame, product: str, days: int = RECENT_DAYS) -> DataFrame:
    """:func:`recent_sales` of one product as SQL text with parameters, for SQL clients.

    The product's newest day is a window over its daily totals, so the sales are scanned once.
    """
    query = """
        WITH diario AS (
            SELECT id_producto, fecha_venta, sum(unidades_vendidas) AS unidades,
                max(fecha_venta) OVER (PARTITION BY id_producto) AS ultima
            FROM {ventas} WHERE id_producto = :product GROUP BY ALL)
        SELECT id_producto, fecha_venta, unidades FROM diario
        WHERE datediff(ultima, fecha_venta) <= :days
    """
    return ventas.sparkSession.sql(query, args={"product": product, "days": days}, ventas=ventas)


def recent_sales_lists(ventas: DataFrame, product: str | None = None) -> DataFrame:
    return _parallel_lists(recent_sales(ventas, product), "id_producto", "fecha_venta",
                           unidades=F.col("unidades"))


def monthly_sales_last_year(ventas: DataFrame, product: str | None = None,
                            months: int = 12) -> DataFrame:
    """Units per product and month over the last months of each product."""
    month = month_start(F.col("fecha_venta"))
    monthly = only_product(ventas, product).groupBy("id_producto", month.alias("mes")).agg(
        F.sum("unidades_vendidas").alias("unidades"))
    newest = F.max("mes").over(Window.partitionBy("id_producto"))
    monthly = monthly.withColumn("ultimo", newest)
    return monthly.filter(F.col("mes") > F.add_months("ultimo", -months)).drop("ultimo")


def mean_confidence(predicciones: DataFrame) -> DataFrame:
    """Mean confidence per product: missing values count as 0, not as absent."""
    given = F.coalesce(F.col("confianza_modelo").cast("double"), F.lit(0.0))
    return predicciones.filter(F.col("id_producto").isNotNull()).groupBy("id_producto").agg(
        (F.sum(given) / F.count(F.lit(1))).alias("confianza"))


def forecast_lists(predicciones: DataFrame, product: str | None = None) -> DataFrame:
    """Forecast per product as lists, with its mean confidence to 4 digits."""
    rows = only_product(predicciones, product).filter(F.col("id_producto").isNotNull())
    point = F.struct(
        F.col("fecha_prediccion").alias("f"),
        F.coalesce("unidades_predichas", F.lit(0)).alias("u"))
    given = F.coalesce(F.col("confianza_modelo").cast("double"), F.lit(0.0))
    grouped = rows.groupBy("id_producto").agg(
        F.array_sort(F.collect_list(point)).alias("p"),
        F.round(F.sum(given) / F.count(F.lit(1)), 4).alias("confianza"))
    return grouped.select(
        "id_producto",
        F.transform("p", lambda x: F.date_format(x["f"], "yyyy-MM-dd")).alias("fechas"),
        F.col("p")["u"].alias("predichas"), "confianza")


def global_forecast(predicciones: DataFrame) -> DataFrame:
    """Rows of the global series, the ones without a product, in date order."""
    rows = predicciones.filter(F.col("id_producto").isNull())
    return rows.select(
        "fecha_prediccion",
        F.coalesce("unidades_vendidas", F.lit(0)).alias("reales"),
        F.coalesce("unidades_predichas", F.lit(0)).alias("predichas"),
    ).orderBy("fecha_prediccion")


def global_forecast_lists(predicciones: DataFrame) -> DataFrame:
    return _parallel_lists(global_forecast(predicciones), None, "fecha_prediccion",
                           reales=F.col("reales"), predichas=F.col("predichas"))


def investment(predicciones: DataFrame, productos: DataFrame,
               product: str | None = None) -> DataFrame:
    """Planned investment per product and month: units times price, exact decimals.

    Products without a catalogue row have none. The price side is joined by measured size.
    """
    price = only_product(productos, product).select("id_producto", "precio_unitario")
    units = F.coalesce("unidades_predichas", F.lit(0))
    cost = units * F.col("precio_unitario").cast("decimal(10,2)")
    return only_product(predicciones, product).join(price, "id_producto").select(
        "id_producto", "fecha_prediccion", cost.cast("decimal(18,2)").alias("inversion"))


def investment_lists(predicciones: DataFrame, productos: DataFrame,
                     product: str | None = None) -> DataFrame:
    return _parallel_lists(investment(predicciones, productos, product), "id_producto",
                           "fecha_prediccion", inversion=F.col("inversion"))


def confidence_gauge(confidences: DataFrame) -> DataFrame:
    """Confidence as percent, its complement, and the text of the key figure."""
    percent = F.coalesce(F.col("confianza") * 100, F.lit(0.0))
    text = F.format_string("%.1f%%", F.col("confianza") * 100)
    text = F.when(F.col("confianza").isNotNull(), text)
    return confidences.select(
        "*", percent.alias("porcentaje"), (100 - percent).alias("margen"),
        F.coalesce(text, F.lit(NO_CONFIDENCE_TEXT)).alias("texto"))
