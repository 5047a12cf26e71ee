"""Read queries over the stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from surtido.constants import PRODUCT_LIST_LIMIT
from surtido.operators import serving as v
from surtido.operators.allocation import product_shares
from surtido.operators.ridge import confidence, error_metrics
from surtido.registry.base import (
    PLANNED, PRODUCT, SERIES, STORED, MEAN_FORECAST, clean, listed, mean_fit, mean_forecast,
    mean_predictions, months_of, plain, planned, productos, r_sql, rounded, sql, stored, ventas,
)


def _kpis(s, d):
    products, sales = stored(s, d)
    return plain(v.kpis(sales, products))


def _investment(s, d):
    products, _, predicciones = planned(s, d)
    return plain(v.investment(predicciones, products))


def _investment_arrays(s, d):
    products, _, predicciones = planned(s, d)
    return listed(v.investment_lists(predicciones, products), "fechas", "inversion")


QUERIES = {
    "kpis": _kpis,
    "product_list": lambda s, d: v.product_list(productos(s, d)),
    "product_list_page": lambda s, d: v.product_list(productos(s, d), PRODUCT_LIST_LIMIT),
    "product_label": lambda s, d: v.product_labels(productos(s, d)),
    "daily_sales_by_product": lambda s, d: v.daily_sales(ventas(s, d)),
    "sales_last_30d_one": lambda s, d: v.recent_sales(ventas(s, d), PRODUCT),
    "sales_last_30d_sql": lambda s, d: v.recent_sales_sql(ventas(s, d), PRODUCT),
    "sales_last_30d_all": lambda s, d: v.recent_sales(ventas(s, d)),
    "sales_series_arrays": lambda s, d: listed(v.recent_sales_lists(ventas(s, d)),
                                               "fechas", "unidades"),
    "monthly_units_last_year": lambda s, d: v.monthly_sales_last_year(ventas(s, d)),
    "product_share": lambda s, d: product_shares(ventas(s, d)),
    "mean_forecast": lambda s, d: mean_forecast(months_of(clean(s, d))),
    "fit_metrics": lambda s, d: rounded(error_metrics(mean_fit(months_of(clean(s, d)))), "rmse", "mae", "r2"),
    "fit_confidence": lambda s, d: rounded(
        confidence(error_metrics(mean_fit(months_of(clean(s, d))))), "confianza"),
    "allocate_forecast": lambda s, d: plain(mean_predictions(s, d)),
    "forecast_by_product": lambda s, d: listed(
        v.forecast_lists(mean_predictions(s, d)), "fechas", "predichas"),
    "forecast_one_product": lambda s, d: listed(
        v.forecast_lists(mean_predictions(s, d), PRODUCT), "fechas", "predichas"),
    "global_forecast": lambda s, d: v.global_forecast(mean_predictions(s, d)),
    "global_forecast_arrays": lambda s, d: listed(
        v.global_forecast_lists(mean_predictions(s, d)), "fechas", "reales", "predichas"),
    "investment": _investment,
    "investment_arrays": _investment_arrays,
    "confidence_mean": lambda s, d: rounded(
        v.mean_confidence(mean_predictions(s, d)), "confianza"),
    "confidence_gauge": lambda s, d: rounded(
        v.confidence_gauge(v.mean_confidence(mean_predictions(s, d))),
        "confianza", "porcentaje", "margen"),
    "confidence_gauge_missing": lambda s, d: v.confidence_gauge(
        productos(s, d).select("id_producto", F.lit(None).cast("double").alias("confianza"))),
}

_RECENT = ("recent", """
    SELECT v.id_producto, fecha_venta, CAST(sum(unidades_vendidas) AS BIGINT) AS unidades
    FROM ventas v
    JOIN (SELECT id_producto, max(fecha_venta) AS ultima FROM ventas GROUP BY id_producto) u
        ON v.id_producto = u.id_producto AND fecha_venta >= ultima - INTERVAL 30 DAY
    GROUP BY v.id_producto, fecha_venta""")

_BY_PRODUCT = """
    SELECT id_producto, string_agg(strftime(fecha_prediccion, '%Y-%m-%d'), ','
            ORDER BY fecha_prediccion) AS fechas,
        string_agg(CAST(coalesce(unidades_predichas, 0) AS VARCHAR), ','
            ORDER BY fecha_prediccion) AS predichas,
        round(sum(coalesce(CAST(confianza_modelo AS DOUBLE), 0)) / count(*), 4) AS confianza
    FROM predicciones WHERE id_producto IS NOT NULL {where} GROUP BY id_producto"""

_INVESTMENT = ("invested", """
    SELECT f.id_producto, fecha_prediccion,
        CAST(coalesce(unidades_predichas, 0) * precio_unitario AS DECIMAL(18,2)) AS inversion
    FROM predicciones f JOIN productos p ON f.id_producto = p.id_producto""")

_MEAN = ("means", """
    SELECT id_producto, sum(coalesce(CAST(confianza_modelo AS DOUBLE), 0)) / count(*) AS confianza
    FROM predicciones WHERE id_producto IS NOT NULL GROUP BY id_producto""")

_GLOBAL = ("global_rows", """
    SELECT fecha_prediccion, coalesce(unidades_vendidas, 0) AS reales,
        coalesce(unidades_predichas, 0) AS predichas
    FROM predicciones WHERE id_producto IS NULL""")

ORACLES = {
    "kpis": sql(STORED, """
        SELECT CAST(coalesce(sum(total_venta), 0) AS DOUBLE) AS ventas_totales,
            CAST(coalesce(sum(unidades_vendidas), 0) AS BIGINT) AS unidades_totales,
            (SELECT count(*) FROM productos) AS productos_distintos
        FROM ventas"""),
    "product_list": sql(STORED, """
        SELECT id_producto, nombre FROM productos ORDER BY nombre, id_producto"""),
    "product_list_page": sql(STORED, """
        SELECT id_producto, nombre FROM productos ORDER BY nombre, id_producto LIMIT 500"""),
    "product_label": sql(STORED, """
        SELECT id_producto, nombre,
            id_producto || ' — ' || substring(nombre, 1, 40) AS etiqueta FROM productos"""),
    "daily_sales_by_product": sql(STORED, """
        SELECT id_producto, fecha_venta, CAST(sum(unidades_vendidas) AS BIGINT) AS unidades
        FROM ventas GROUP BY ALL"""),
    "sales_last_30d_one": sql(STORED, f"""
        SELECT id_producto, fecha_venta, CAST(sum(unidades_vendidas) AS BIGINT) AS unidades
        FROM ventas WHERE id_producto = '{PRODUCT}' AND fecha_venta >= (
            SELECT max(fecha_venta) - INTERVAL 30 DAY FROM ventas WHERE id_producto = '{PRODUCT}')
        GROUP BY ALL"""),
    "sales_last_30d_sql": sql((*STORED, _RECENT),
                              f"SELECT * FROM recent WHERE id_producto = '{PRODUCT}'"),
    "sales_last_30d_all": sql((*STORED, _RECENT), "SELECT * FROM recent"),
    "sales_series_arrays": sql((*STORED, _RECENT), """
        SELECT id_producto,
            string_agg(strftime(fecha_venta, '%Y-%m-%d'), ',' ORDER BY fecha_venta) AS fechas,
            string_agg(CAST(unidades AS VARCHAR), ',' ORDER BY fecha_venta) AS unidades
        FROM recent GROUP BY id_producto"""),
    "monthly_units_last_year": sql((*STORED, ("per_month", """
        SELECT id_producto, CAST(date_trunc('month', fecha_venta) AS DATE) AS mes,
            CAST(sum(unidades_vendidas) AS BIGINT) AS unidades
        FROM ventas GROUP BY ALL""")), """
        SELECT p.* FROM per_month p
        JOIN (SELECT id_producto, max(mes) AS ultimo FROM per_month GROUP BY ALL) u
            ON p.id_producto = u.id_producto AND mes > ultimo - INTERVAL 12 MONTH"""),
    "product_share": sql(PLANNED, "SELECT * FROM shares"),
    "mean_forecast": sql(PLANNED, "SELECT * FROM forecast"),
    "fit_metrics": sql((*SERIES, *MEAN_FORECAST[:3]), f"""
        SELECT series_key, count(*) AS n_test,
            {r_sql('sqrt(avg((ventas_reales - ventas_predichas) ** 2))')} AS rmse,
            {r_sql('avg(abs(ventas_reales - ventas_predichas))')} AS mae,
            {r_sql('''1 - sum((ventas_reales - ventas_predichas) ** 2)
                / (var_pop(ventas_reales) * count(*))''')} AS r2
        FROM scored GROUP BY series_key"""),
    "fit_confidence": sql((*SERIES, *MEAN_FORECAST[:4]), f"""
        SELECT 'global' AS series_key, {r_sql('confianza')} AS confianza FROM score"""),
    "allocate_forecast": sql(PLANNED, """
        SELECT * REPLACE (CAST(confianza_modelo AS DOUBLE) AS confianza_modelo) FROM predicciones"""),
    "forecast_by_product": sql(PLANNED, _BY_PRODUCT.format(where="")),
    "forecast_one_product": sql(
        PLANNED, _BY_PRODUCT.format(where=f"AND id_producto = '{PRODUCT}'")),
    "global_forecast": sql((*PLANNED, _GLOBAL), "SELECT * FROM global_rows"),
    "global_forecast_arrays": sql((*PLANNED, _GLOBAL), """
        SELECT string_agg(strftime(fecha_prediccion, '%Y-%m-%d'), ','
                ORDER BY fecha_prediccion) AS fechas,
            string_agg(CAST(reales AS VARCHAR), ',' ORDER BY fecha_prediccion) AS reales,
            string_agg(CAST(predichas AS VARCHAR), ',' ORDER BY fecha_prediccion) AS predichas
        FROM global_rows"""),
    "investment": sql((*PLANNED, _INVESTMENT), """
        SELECT * REPLACE (CAST(inversion AS DOUBLE) AS inversion) FROM invested"""),
    "investment_arrays": sql((*PLANNED, _INVESTMENT), """
        SELECT id_producto,
            string_agg(strftime(fecha_prediccion, '%Y-%m-%d'), ','
                ORDER BY fecha_prediccion) AS fechas,
            string_agg(CAST(inversion AS VARCHAR), ',' ORDER BY fecha_prediccion) AS inversion
        FROM invested GROUP BY id_producto"""),
    "confidence_mean": sql((*PLANNED, _MEAN),
                           f"SELECT id_producto, {r_sql('confianza')} AS confianza FROM means"),
    "confidence_gauge": sql((*PLANNED, _MEAN), f"""
        SELECT id_producto, {r_sql('confianza')} AS confianza,
            {r_sql('confianza * 100')} AS porcentaje, {r_sql('100 - confianza * 100')} AS margen,
            format('{{:.1f}}%', confianza * 100) AS texto
        FROM means"""),
    "confidence_gauge_missing": sql(STORED, """
        SELECT id_producto, CAST(NULL AS DOUBLE) AS confianza, CAST(0 AS DOUBLE) AS porcentaje,
            CAST(100 AS DOUBLE) AS margen, 'Sin datos' AS texto FROM productos"""),
}
