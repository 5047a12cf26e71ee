"""Cleaning of invoice lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from surtido.functions import parse_timestamp, round_half_even
from surtido.operators import cleaning as c
from surtido.operators.audit import cleaning_audit, dataset_report
from surtido.operators.dates import date_shapes, infer_formats
from surtido.registry.base import LINES, clean, raw, sql
from surtido.session import fresh_folder

# How a country writes its dates, by the last digit of its number: format, the same for the
# twin, and its shape.
DATE_TEXTS = (
    ("dd/MM/yyyy HH:mm", "%d/%m/%Y %H:%M", "9/9/Y 9:9"),
    ("d/M/yyyy", "%-d/%-m/%Y", "9/9/Y"),
    ("d-MMM-yyyy", "%-d-%b-%Y", "9-a-Y"),
    ("yyyy.MM.dd", "%Y.%m.%d", "Y.9.9"),
    ("yyyy-MM-dd", "%Y-%m-%d", "Y-9-9"),
)


def _date_texts(s, d):
    """The raw lines with dates as their countries write them, the day before the month."""
    lines = raw(s, d)
    kind = F.substring("Country", -1, 1).cast("int") % len(DATE_TEXTS)
    texts = F.coalesce(*[F.when(kind == i, F.date_format("InvoiceDate", pattern))
                         for i, (pattern, _, _) in enumerate(DATE_TEXTS)])
    return lines.select("InvoiceNo", F.col("InvoiceDate").alias("antes"),
                        texts.alias("InvoiceDate"))


def _inferred(s, d):
    """The date texts read with the formats that their shapes give."""
    texts, path = _date_texts(s, d), f"{fresh_folder(s)}/textos"
    texts.write.parquet(path)  # read twice: for the formats, and with them
    lines = s.read.schema(texts.schema).parquet(path)
    found = infer_formats(lines, "InvoiceDate")
    return lines.select("InvoiceNo", F.to_date(parse_timestamp(
        F.col("InvoiceDate"), found.formats)).alias("fecha"), F.lit(found.ambiguous).cast(
        "bigint").alias("ambiguas"), F.lit(found.unread).cast("bigint").alias("sin_leer"))


RAW_COLUMNS = ('"InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", '
               '"UnitPrice", "CustomerID", "Country"')

QUERIES = {
    "invoice_lines": raw,
    "clean_lines": clean,
    "clean_audit": lambda s, d: cleaning_audit(c.count_copies(raw(s, d))),
    "dataset_report": lambda s, d: dataset_report(raw(s, d)),
    "drop_cancelled": lambda s, d: c.drop_cancelled(raw(s, d)),
    "drop_nonpositive": lambda s, d: c.keep_positive(raw(s, d)),
    "exact_dedup": lambda s, d: c.drop_exact_duplicates(raw(s, d)),
    "fill_nulls": lambda s, d: c.fill_missing(raw(s, d)),
    "normalize_text": lambda s, d: c.normalize_text(raw(s, d)),
    "normalize_dates": lambda s, d: c.normalize_dates(raw(s, d)),
    "date_shapes": lambda s, d: date_shapes(_date_texts(s, d), "InvoiceDate").fillna(
        0, ["mayor_1", "mayor_2"]),
    "inferred_dates": _inferred,
    "line_total": lambda s, d: c.add_line_total(raw(s, d)).select(
        "InvoiceNo", "Quantity", "UnitPrice", "total_venta"),
    "rename_columns": lambda s, d: c.to_internal_names(raw(s, d)),
    "round_half_even": lambda s, d: raw(s, d).groupBy(
        round_half_even(F.col("UnitPrice") / 8, 1).alias("octavo")).agg(
        F.count(F.lit(1)).alias("filas")),
}

_RENAMED = ('"InvoiceNo" AS id_venta_original, "StockCode" AS id_producto, '
            '"Description" AS nombre, "Quantity" AS unidades_vendidas, '
            '"InvoiceDate" AS fecha_venta, "UnitPrice" AS precio_unitario, '
            '"CustomerID", "Country"')

_KIND = f"CAST(right(\"Country\", 1) AS INTEGER) % {len(DATE_TEXTS)}"
_CASES = " ".join(f"WHEN {i} THEN '{shape}'" for i, (_, _, shape) in enumerate(DATE_TEXTS))
_TEXTS = " ".join(f"WHEN {i} THEN strftime(\"InvoiceDate\", '{text}')"
                  for i, (_, text, _) in enumerate(DATE_TEXTS))

ORACLES = {
    "date_shapes": sql(LINES, f"""
        SELECT CASE {_KIND} {_CASES} END AS forma, count(*) AS filas,
            max(CASE WHEN {_KIND} < 3 THEN day("InvoiceDate") ELSE month("InvoiceDate") END)
                AS mayor_1,
            max(CASE {_KIND} WHEN 0 THEN month("InvoiceDate") WHEN 1 THEN month("InvoiceDate")
                WHEN 2 THEN 0 ELSE day("InvoiceDate") END) AS mayor_2,
            min(CASE {_KIND} {_TEXTS} END) AS ejemplo
        FROM raw GROUP BY {_KIND}"""),
    "inferred_dates": sql(LINES, """
        SELECT "InvoiceNo", CAST("InvoiceDate" AS DATE) AS fecha, CAST(0 AS BIGINT) AS ambiguas,
            CAST(0 AS BIGINT) AS sin_leer FROM raw"""),
    "invoice_lines": sql(LINES, "SELECT * FROM raw"),
    "clean_lines": sql(LINES, "SELECT * FROM clean"),
    "clean_audit": sql(LINES, """
        SELECT 0 AS orden, 'inicio' AS paso, (SELECT count(*) FROM raw) AS filas
        UNION ALL SELECT 1, 'sin_cancelaciones', (SELECT count(*) FROM sold)
        UNION ALL SELECT 2, 'cantidad_positiva', (SELECT count(*) FROM sold WHERE "Quantity" > 0)
        UNION ALL SELECT 3, 'precio_positivo', (SELECT count(*) FROM kept)
        UNION ALL SELECT 4, 'sin_duplicados', (SELECT count(*) FROM uniques)"""),
    "dataset_report": sql(LINES, "SELECT count(*) AS filas, 8 AS columnas FROM raw"),
    "drop_cancelled": sql(LINES, "SELECT * FROM sold"),
    "drop_nonpositive": sql(LINES, """
        SELECT * FROM raw WHERE "Quantity" > 0 AND "UnitPrice" > 0"""),
    "exact_dedup": sql(LINES, "SELECT DISTINCT * FROM raw"),
    "fill_nulls": sql(LINES, """
        SELECT * REPLACE (coalesce("Description", 'Sin descripción') AS "Description",
            CAST(coalesce("CustomerID", 0) AS BIGINT) AS "CustomerID") FROM raw"""),
    "normalize_text": sql(LINES, """
        SELECT * REPLACE (upper(trim("Description")) AS "Description",
            upper(trim("StockCode")) AS "StockCode") FROM raw"""),
    "normalize_dates": sql(LINES, """
        SELECT * REPLACE (CAST("InvoiceDate" AS DATE) AS "InvoiceDate") FROM raw"""),
    "line_total": sql(LINES, """
        SELECT "InvoiceNo", "Quantity", "UnitPrice",
            round_even("Quantity" * "UnitPrice" * 100, 0) / 100 AS total_venta FROM raw"""),
    "rename_columns": sql(LINES, f"SELECT {_RENAMED} FROM raw"),
    "round_half_even": sql(LINES, """
        SELECT round_even("UnitPrice" / 8 * 10, 0) / 10 AS octavo, count(*) AS filas
        FROM raw GROUP BY ALL"""),
}
