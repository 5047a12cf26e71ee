"""Product filter, catalogue and sales facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surtido.operators import catalog as c
from surtido.operators.audit import split_audit
from surtido.registry.base import (
    ACTIVE, CUTOFF, LINES, STORED, clean, fresh_folder, plain, productos, sold, sql, valid, ventas,
)
from surtido.sinks import write_days

def _cutoff(lines: DataFrame) -> DataFrame:
    first = lines.agg(F.min("fecha_venta").alias("primera"))
    return first.withColumn("desde", c.recent_cutoff(lines))


QUERIES = {
    "recent_cutoff": lambda s, d: _cutoff(sold(s, d)),
    "last_month_lines": lambda s, d: c.last_month_lines(clean(s, d)),
    "active_days_per_product": lambda s, d: c.active_days(sold(s, d)),
    "valid_products": lambda s, d: c.valid_products(sold(s, d)),
    "lines_of_valid_products": lambda s, d: c.keep_valid(clean(s, d), valid=valid(s, d)),
    "catalog_top_price": lambda s, d: plain(productos(s, d)),
    "catalog_top_price_all": lambda s, d: c.top_price_catalog(sold(s, d)),
    "sales_fact": lambda s, d: plain(ventas(s, d)),
    "split_counts": lambda s, d: split_audit(write_days(c.day_masks(clean(s, d)), fresh_folder(s))),
}

ORACLES = {
    "recent_cutoff": sql((*LINES, CUTOFF), """
        SELECT min(fecha_venta) AS primera, (SELECT desde FROM cutoff) AS desde FROM clean"""),
    "last_month_lines": sql((*LINES, CUTOFF), """
        SELECT * FROM clean WHERE fecha_venta >= (SELECT desde FROM cutoff)"""),
    "active_days_per_product": sql((*LINES, CUTOFF, ACTIVE), "SELECT * FROM active"),
    "valid_products": sql((*LINES, CUTOFF, ACTIVE), "SELECT * FROM active WHERE dias_vendido >= 5"),
    "lines_of_valid_products": sql(STORED, "SELECT * FROM alive"),
    "catalog_top_price": sql(STORED, "SELECT * REPLACE (CAST(precio_unitario AS DOUBLE) AS precio_unitario) FROM productos"),
    "catalog_top_price_all": sql(LINES, """
        SELECT id_producto, nombre, 'Sin categoría' AS categoria, precio_unitario
        FROM (SELECT *, row_number() OVER (PARTITION BY id_producto
                  ORDER BY precio_unitario DESC, nombre NULLS LAST) AS puesto FROM clean)
        WHERE puesto = 1"""),
    "sales_fact": sql(STORED, "SELECT * REPLACE (CAST(total_venta AS DOUBLE) AS total_venta) FROM ventas"),
    "split_counts": sql(STORED, """
        SELECT 0 AS orden, 'productos_excluidos' AS medida,
            (SELECT count(*) FROM active WHERE dias_vendido < 5) AS filas
        UNION ALL SELECT 1, 'productos_unicos', (SELECT count(*) FROM productos)
        UNION ALL SELECT 2, 'filas_antes', (SELECT count(*) FROM clean)
        UNION ALL SELECT 3, 'filas_restantes', (SELECT count(*) FROM ventas)"""),
}
