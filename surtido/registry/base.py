"""Inputs the queries share, in their Spark form and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surtido.operators.allocation import allocate, global_rows, product_shares, to_forecast_rows
from surtido.operators.catalog import (
    day_masks, keep_valid, sales_fact, split_tables, top_price_catalog, valid_products,
)
from surtido.operators.cleaning import clean_lines, keep_sales, normalize_lines
from surtido.operators.ridge import confidence, error_metrics
from surtido.operators.series import KEY, covered_months, monthly_units
from surtido.plans.reload import store_clean
from surtido.schemas import to_stored
from surtido.session import fresh_folder
from surtido.sinks import write_days, write_series, write_valid
from surtido.sources.invoices import invoice_lines

# Series by country: a country sells on too few days for the coverage of the global series.
COUNTRY_KEYS = ("Country",)
COUNTRY_DAYS = 5
# The product of the one-product queries.
PRODUCT = "BRAND#1-ECONOMY"


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return invoice_lines(spark, folder)


def clean(spark: SparkSession, folder: str) -> DataFrame:
    return clean_lines(raw(spark, folder))


def sold(spark: SparkSession, folder: str) -> DataFrame:
    """Clean lines with their copies: for results that copies do not change."""
    return normalize_lines(keep_sales(raw(spark, folder)))


def stored(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(productos, ventas) with stored types.

    The clean lines and the active days are written first, as in the reload, so the raw
    tables are scanned and cleaned once.
    """
    lines, kept = written(spark, folder, fresh_folder(spark))
    products, sales = split_tables(lines, valid=kept)
    return to_stored(products, "productos"), to_stored(sales, "ventas")


def valid(spark: SparkSession, folder: str) -> DataFrame:
    """The valid products, written; copies of lines do not change who is valid."""
    return write_valid(valid_products(sold(spark, folder)), fresh_folder(spark))


def productos(spark: SparkSession, folder: str) -> DataFrame:
    """The catalogue alone. Copies of lines do not change a top price, so none are removed."""
    lines = keep_valid(sold(spark, folder), valid=valid(spark, folder))
    return to_stored(top_price_catalog(lines), "productos")


def ventas(spark: SparkSession, folder: str) -> DataFrame:
    """The sales facts alone."""
    lines = keep_valid(clean(spark, folder), valid=valid(spark, folder))
    return to_stored(sales_fact(lines), "ventas")


def written(spark: SparkSession, folder: str, warehouse: str) -> tuple[DataFrame, DataFrame]:
    """(clean lines, valid products), both written to a warehouse."""
    lines = store_clean(raw(spark, folder), warehouse)
    days = write_days(day_masks(lines), warehouse)
    return lines, write_valid(valid_products(days=days), warehouse)


def months_of(lines: DataFrame) -> DataFrame:
    return covered_months(monthly_units(lines))


def mean_forecast(monthly: DataFrame) -> DataFrame:
    """Stand-in forecast without a model: the mean of the same month of all years."""
    year = monthly.agg(F.year(F.max("fecha")) + 1).scalar()
    means = monthly.groupBy(KEY, F.month("fecha").alias("mes")).agg(
        (F.sum("ventas").cast("double") / F.count(F.lit(1))).alias("ventas_predichas"))
    return means.select(
        KEY, F.make_date(year, "mes", F.lit(1)).alias("fecha"), "ventas_predichas",
        F.col("ventas_predichas").alias("ventas_reales"))


def mean_fit(monthly: DataFrame) -> DataFrame:
    """Actual units and the mean of their calendar month, as pairs to score."""
    same_month = Window.partitionBy(KEY, F.month("fecha"))
    mean = F.sum("ventas").over(same_month).cast("double") / F.count(F.lit(1)).over(same_month)
    return monthly.select(
        KEY, "fecha", F.col("ventas").cast("double").alias("ventas_reales"),
        mean.alias("ventas_predichas"))


def planned(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(productos, ventas, predicciones), with the stand-in forecast.

    Many branches start at the same few months and products, so these are written first, as
    in the reload, and the branches scan rows that are summed already.
    """
    warehouse = fresh_folder(spark)
    lines, kept = written(spark, folder, warehouse)
    products, sales = split_tables(lines, valid=kept)
    monthly = write_series(months_of(lines), warehouse)
    forecast = mean_forecast(monthly)
    score = confidence(error_metrics(mean_fit(monthly))).select("confianza").scalar()
    rows = allocate(forecast, product_shares(sales), score)
    predicciones = to_forecast_rows(rows.unionByName(global_rows(forecast, score)))
    return to_stored(products, "productos"), to_stored(sales, "ventas"), predicciones


def mean_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Forecast rows of the stand-in: every product, and the global series."""
    return planned(spark, folder)[2]


def r(column: str | Column, digits: int = 6) -> Column:
    """Rounded for comparison; adding 0 turns a negative zero into zero."""
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c, digits) + F.lit(0.0)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: r(c, digits) for c in columns})


def plain(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles, which every client compares alike."""
    decimals = [f.name for f in df.schema if f.dataType.typeName() == "decimal"]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})


def listed(df: DataFrame, *columns: str) -> DataFrame:
    """Lists as comma-separated text."""
    return df.withColumns({
        c: F.array_join(F.transform(c, lambda v: v.cast("string")), ",") for c in columns
    })


# --- SQL ----------------------------------------------------------------------

RAW = ("raw", """
    SELECT lines.* EXCLUDE (okey) FROM (
        SELECT l_orderkey AS okey,
            CASE WHEN l_returnflag = 'R' AND l_tax = 0 THEN 'C' ELSE '' END
                || CAST(l_orderkey AS VARCHAR) AS "InvoiceNo",
            lower(p_brand) || '-' || p_type || ' ' AS "StockCode",
            CASE WHEN p_size <> 1 THEN ' ' || p_name || ' ' END AS "Description",
            CASE WHEN l_returnflag = 'A' AND l_tax = 0 THEN -CAST(l_quantity AS INTEGER)
                ELSE CAST(l_quantity AS INTEGER) END AS "Quantity",
            l_shipdate AS "InvoiceDate",
            CASE WHEN l_discount = 0 AND l_returnflag = 'N' THEN CAST(0 AS DOUBLE)
                ELSE round_even(l_extendedprice / l_quantity * 100, 0) / 100 END AS "UnitPrice",
            CASE WHEN o_custkey % 10 <> 0 THEN CAST(o_custkey AS DOUBLE) END AS "CustomerID",
            n_name AS "Country"
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN part ON l_partkey = p_partkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
    ) lines
    JOIN (VALUES (0), (1)) copies(copy) ON copy = 0 OR okey % 10 = 7""")

SOLD = ("sold", """
    SELECT * FROM raw WHERE NOT coalesce(starts_with("InvoiceNo", 'C'), FALSE)""")

KEPT = ("kept", """
    SELECT * FROM sold WHERE "Quantity" > 0 AND "UnitPrice" > 0 AND NOT isnan("UnitPrice")""")

UNIQUES = ("uniques", "SELECT DISTINCT * FROM kept")

CLEAN = ("clean", """
    SELECT "InvoiceNo" AS id_venta_original,
        upper(trim("StockCode")) AS id_producto,
        upper(trim(coalesce("Description", 'Sin descripción'))) AS nombre,
        "Quantity" AS unidades_vendidas,
        CAST("InvoiceDate" AS DATE) AS fecha_venta,
        "UnitPrice" AS precio_unitario,
        CAST(coalesce("CustomerID", 0) AS BIGINT) AS "CustomerID",
        "Country",
        round_even("Quantity" * "UnitPrice" * 100, 0) / 100 AS total_venta
    FROM uniques""")

LINES = (RAW, SOLD, KEPT, UNIQUES, CLEAN)

CUTOFF = ("cutoff", """
    SELECT CAST(max(fecha_venta) - INTERVAL 1 MONTH AS DATE) AS desde FROM clean""")

ACTIVE = ("active", """
    SELECT id_producto, count(DISTINCT fecha_venta) AS dias_vendido
    FROM clean WHERE fecha_venta >= (SELECT desde FROM cutoff) GROUP BY id_producto""")

ALIVE = ("alive", """
    SELECT * FROM clean
    WHERE id_producto IN (SELECT id_producto FROM active WHERE dias_vendido >= 5)""")

PRODUCTOS = ("productos", """
    SELECT id_producto, nombre, 'Sin categoría' AS categoria,
        CAST(precio_unitario AS DECIMAL(10,2)) AS precio_unitario
    FROM (SELECT id_producto, nombre, precio_unitario, row_number() OVER (
              PARTITION BY id_producto ORDER BY precio_unitario DESC, nombre NULLS LAST) AS puesto
          FROM alive)
    WHERE puesto = 1""")

VENTAS = ("ventas", """
    SELECT id_venta_original, id_producto, fecha_venta, unidades_vendidas,
        CAST(total_venta AS DECIMAL(10,2)) AS total_venta
    FROM alive""")

STORED = (*LINES, CUTOFF, ACTIVE, ALIVE, PRODUCTOS, VENTAS)


def monthly_ctes(key: str = "'global'", days: int = 25) -> tuple[tuple[str, str], ...]:
    """daily, monthly, covered and serie for one choice of series."""
    return (
        ("daily", f"""
    SELECT {key} AS series_key, fecha_venta AS fecha,
        CAST(sum(unidades_vendidas) AS BIGINT) AS ventas
    FROM clean GROUP BY ALL"""),
        ("monthly", """
    SELECT series_key, CAST(date_trunc('month', fecha) AS DATE) AS fecha,
        CAST(sum(ventas) AS BIGINT) AS ventas, count(*) AS dias
    FROM daily GROUP BY ALL"""),
        ("covered", f"SELECT * FROM monthly WHERE dias >= {days}"),
        ("serie", "SELECT series_key, fecha, CAST(ventas AS DOUBLE) AS ventas FROM covered"),
    )


SERIES = (*LINES, *monthly_ctes())
COUNTRY_SERIES = (*LINES, *monthly_ctes('"Country"', COUNTRY_DAYS))

MEAN_FORECAST = (
    ("month_means", """
    SELECT series_key, month(fecha) AS mes,
        CAST(sum(ventas) AS DOUBLE) / count(*) AS media FROM covered GROUP BY ALL"""),
    ("forecast", """
    SELECT series_key, make_date((SELECT year(max(fecha)) + 1 FROM covered), mes, 1) AS fecha,
        media AS ventas_predichas, media AS ventas_reales FROM month_means"""),
    ("scored", """
    SELECT covered.series_key, fecha, CAST(ventas AS DOUBLE) AS ventas_reales,
        media AS ventas_predichas
    FROM covered JOIN month_means
        ON covered.series_key = month_means.series_key AND month(fecha) = mes"""),
    ("score", """
    SELECT greatest(0, least(1, 1 - sum((ventas_reales - ventas_predichas) ** 2)
        / (var_pop(ventas_reales) * count(*)))) AS confianza FROM scored"""),
    ("shares", """
    SELECT id_producto, CAST(sum(unidades_vendidas) AS BIGINT) AS unidades,
        CAST(sum(unidades_vendidas) AS DOUBLE)
            / (SELECT CAST(sum(unidades_vendidas) AS DOUBLE) FROM ventas) AS cuota
    FROM ventas GROUP BY id_producto"""),
    ("predicciones", """
    SELECT id_producto, fecha AS fecha_prediccion,
        CAST(round_even(ventas_predichas * cuota, 0) AS BIGINT) AS unidades_predichas,
        CAST(round_even(ventas_reales * cuota, 0) AS BIGINT) AS unidades_vendidas,
        CAST((SELECT confianza FROM score) AS DECIMAL(5,4)) AS confianza_modelo
    FROM forecast CROSS JOIN shares
    UNION ALL
    SELECT NULL, fecha, CAST(round_even(ventas_predichas, 0) AS BIGINT),
        CAST(round_even(ventas_reales, 0) AS BIGINT),
        CAST((SELECT confianza FROM score) AS DECIMAL(5,4))
    FROM forecast"""),
)

PLANNED = (*STORED, *monthly_ctes(), *MEAN_FORECAST)


def sql(ctes: tuple[tuple[str, str], ...], final: str, recursive: bool = False) -> str:
    body = ",\n".join(f"{name} AS ({text})" for name, text in ctes)
    return f"WITH {'RECURSIVE ' if recursive else ''}{body}\n{final}"


def r_sql(expression: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0.0"
