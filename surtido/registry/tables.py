"""Sinks, keys, constraints, file formats and streams, each read back as a query.

The queries that write use a new folder under the shared checkpoint folder each time.
"""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surtido.constants import RECENT_DAYS
from surtido.operators import constraints as k
from surtido.operators.allocation import to_forecast_rows
from surtido.operators.catalog import sales_fact
from surtido.operators.cleaning import clean_stream, normalize_lines
from surtido.operators.forecast import forecast_next_year
from surtido.operators.ridge import fit_models
from surtido.operators.serving import kpis, monthly_sales_last_year, recent_sales
from surtido.plans.reload import reload, store_clean, store_tables
from surtido.registry.base import (
    LINES, PLANNED, STORED, clean, fresh_folder, mean_predictions, plain, planned, productos, raw,
    rounded, sold, sql, ventas,
)
from surtido.registry.catalog import ORACLES as CATALOG_ORACLES
from surtido.registry.lines import ORACLES as LINES_ORACLES
from surtido.registry.model import ORACLES as MODEL_ORACLES, RIDGE_PLAN
from surtido.registry.serving import ORACLES as SERVING_ORACLES
from surtido.registry.series import prepared
from surtido.schemas import to_stored
from surtido.session import remove_folder, send_to_workers, shuffles_freed, state_on_disk
from surtido.sinks import (
    append_sales, clear_tables, dense_key, insert_ignore, missing_products, sales_key,
    write_model,
)
from surtido.sources import (
    load_dataset, read_audit, read_metrics, read_model, read_recent_sales, read_stored, split_unparseable,
    typed,
)
from surtido.sources.files import without_missing_tokens
from surtido.sources.invoices import lines_of, order_tables
from surtido.sources.workbook import workbook_rows
from surtido.streaming.landing import watch_landing
from surtido.streaming.lines import clean_lines_as_they_come, read_clean_lines
from surtido.versions import current


send_to_workers(__name__)

LINES_PER_FILE = 500_000
BYTES_PER_BATCH = 1 << 30


def _unfiltered_facts(s, d) -> DataFrame:
    """Facts of the raw lines as they are: returns and unlisted products included."""
    return sales_fact(normalize_lines(raw(s, d)))


def _all_prices(s, d) -> DataFrame:
    """Product rows as they arrive, many per key."""
    return sold(s, d).select("id_producto", "nombre", F.lit("Sin categoría").alias("categoria"),
                              "precio_unitario")


def _insert_ignore(s, d) -> DataFrame:
    return missing_products(_all_prices(s, d), productos(s, d))


def _stored_products(s, d) -> DataFrame:
    """The product table after the catalogue and then every price row was inserted."""
    folder = fresh_folder(s)
    clear_tables(s, folder)
    insert_ignore(productos(s, d), folder)
    insert_ignore(_all_prices(s, d), folder)
    return plain(read_stored(s, folder, "productos"))


def _surrogate_key(s, d) -> DataFrame:
    order = [F.asc_nulls_first("id_producto"), "fecha_prediccion"]
    return plain(dense_key(mean_predictions(s, d), "id_prediccion", order))


def _sales_keys(s, d) -> DataFrame:
    """The stored sales: every row has a key of its own, above 0."""
    folder = fresh_folder(s)
    clear_tables(s, folder)
    append_sales(sales_fact(clean(s, d)), folder)
    ventas = read_stored(s, folder, "ventas")
    return ventas.agg(
        F.count(F.lit(1)).alias("filas"), (F.min("id_venta") > 0).alias("positivas"),
        F.countDistinct("id_venta").alias("claves"),
        F.sum("unidades_vendidas").alias("unidades"),
        F.sum("total_venta").cast("double").alias("total"))


def _cleared(s, d) -> DataFrame:
    """The sales table is empty again after it was loaded."""
    folder = fresh_folder(s)
    clear_tables(s, folder)
    append_sales(ventas(s, d), folder)
    loaded = read_stored(s, folder, "ventas").count()
    clear_tables(s, folder)
    return read_stored(s, folder, "ventas").agg(F.count(F.lit(1)).alias("quedan")).select(
        F.lit(loaded).cast("bigint").alias("cargadas"), "quedan")


def _violations(s, d) -> DataFrame:
    """Checks of three written tables with keys, the sales as after a load without checks."""
    folder = fresh_folder(s)
    productos, _, predicciones = planned(s, d)
    clear_tables(s, folder)
    productos.write.mode("overwrite").parquet(f"{folder}/productos")
    order = [F.asc_nulls_first("id_producto"), "fecha_prediccion"]
    to_stored(dense_key(predicciones, "id_prediccion", order), "predicciones").write.mode(
        "overwrite").parquet(f"{folder}/predicciones")
    facts = _unfiltered_facts(s, d).select(sales_key(), "*")
    facts.write.parquet(f"{folder}/hechos")
    ventas = s.read.schema(facts.schema).parquet(f"{folder}/hechos")
    return k.validate_constraints(read_stored(s, folder, "productos"), ventas,
                                  read_stored(s, folder, "predicciones"))


def _broken(s, d) -> DataFrame:
    broken = k.broken_rows(_unfiltered_facts(s, d), "ventas")
    return broken.withColumn("restricciones", F.array_join("restricciones", ", "))


def _known(s, d) -> DataFrame:
    return k.split_orphans(_unfiltered_facts(s, d), productos(s, d))[0]


def _set_aside(s, d) -> DataFrame:
    return k.split_orphans(_unfiltered_facts(s, d), productos(s, d))[1]


def _null_safe(s, d) -> DataFrame:
    """Forecast rows as they come: units with decimals, some without a confidence."""
    rows = mean_predictions(s, d).withColumns({
        "unidades_predichas": F.col("unidades_predichas") / 4,
        "unidades_vendidas": F.col("unidades_vendidas") / 8,
        "confianza_modelo": F.when(F.month("fecha_prediccion") % 2 == 0, F.lit(0.87654)),
    })
    return plain(to_forecast_rows(rows))


def _laid_down(lines: DataFrame, path: str) -> DataFrame:
    """The lines, written once: several jobs then scan them instead of joining the tables again."""
    with shuffles_freed(lines.sparkSession):
        lines.write.option("compression", "zstd").parquet(path)
    return lines.sparkSession.read.schema(lines.schema).parquet(path)


def _write_csv(lines: DataFrame, path: str) -> None:
    """CSV files, compressed; they cannot be split then, so none holds many lines."""
    (lines.write.option("header", True).option("escape", '"')
     .option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def _csv(s, d) -> DataFrame:
    path = f"{fresh_folder(s)}/lineas.csv"
    _write_csv(raw(s, d), path)
    return load_dataset(s, path)


def _lenient(s, d) -> DataFrame:
    """Lines set aside by a lenient load: the quantities of one country are not numbers."""
    texts = raw(s, d).withColumn(
        "Quantity", F.when(F.col("Country") == "NATION_3", F.concat(F.lit("x"), "Quantity"))
        .otherwise(F.col("Quantity").cast("string")))
    good, bad = split_unparseable(_laid_down(texts, f"{fresh_folder(s)}/textos"))
    kept = good.agg(F.count(F.lit(1)).alias("buenas"), F.sum("Quantity").alias("unidades"))
    return kept.withColumn("apartadas", bad.agg(F.count(F.lit(1))).scalar())


def _clean_table(s, d) -> DataFrame:
    return store_clean(raw(s, d), fresh_folder(s))


def _loaded(s, d) -> str:
    """A folder of stored tables."""
    folder = fresh_folder(s)
    clear_tables(s, folder)
    append_sales(ventas(s, d), folder)
    return folder


def _stored_recent(s, d) -> DataFrame:
    """Recent sales from the stored months they lie in."""
    return recent_sales(read_recent_sales(s, _loaded(s, d), days=RECENT_DAYS))


def _stored_months(s, d) -> DataFrame:
    return monthly_sales_last_year(read_recent_sales(s, _loaded(s, d), months=12))


def _reloaded(s, d) -> DataFrame:
    """Key figures of the tables that a reload has stored."""
    folder = fresh_folder(s)
    store_tables(store_clean(raw(s, d), folder), folder)
    return plain(kpis(read_stored(s, folder, "ventas"), read_stored(s, folder, "productos")))


def _model_table(s, d) -> DataFrame:
    """The forecast of a model that was stored and read back."""
    folder = fresh_folder(s)
    write_model(fit_models(prepared(s, d)), folder)
    forecast = forecast_next_year(read_model(s, folder))
    return rounded(forecast, "ventas_reales", "ventas_predichas", digits=4)


def _cells(values: list, column: str) -> list[str]:
    """The cells of one column; texts and dates repeat, so each one is written out once."""
    known: dict = {}
    cells = []
    for value in values:
        # Only these: equal numbers can be written differently, as 0.0 and -0.0 are.
        if not isinstance(value, (str, pd.Timestamp)):
            cells.append(_cell(value, column) or "<c/>")
            continue
        cell = known.get(value)
        if cell is None:
            cell = known[value] = _cell(value, column) or "<c/>"
        cells.append(cell)
    return cells


def _cell(value, column: str) -> str:
    if value is None or value != value:
        return ""
    if isinstance(value, str):
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'
    if column == "InvoiceDate":
        days = (value - pd.Timestamp("1899-12-30")) / pd.Timedelta(days=1)
        return f'<c s="1"><v>{days!r}</v></c>'
    return f"<c><v>{value!r}</v></c>"


MAIN_XML = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL_XML = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def workbook(frame: pd.DataFrame) -> bytes:
    """A small workbook with one sheet; every cell names its place by position only."""
    header = "".join(_cell(c, c) for c in frame.columns)
    whole = frame.astype(object)
    columns = [_cells(whole.iloc[:, i].tolist(), c) for i, c in enumerate(frame.columns)]
    body = "".join([f"<row>{''.join(row)}</row>" for row in zip(*columns)] if columns
                   else ["<row></row>"] * len(frame))
    parts = {
        "xl/workbook.xml": f'<workbook {MAIN_XML}><sheets><sheet name="a" sheetId="1" '
                           f'r:id="r1" xmlns:r="{REL_XML}"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels":
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            f'<Relationship Id="r1" Type="{REL_XML}/worksheet" Target="worksheets/s.xml"/>'
            "</Relationships>",
        "xl/styles.xml": f'<styleSheet {MAIN_XML}><cellXfs><xf numFmtId="0"/>'
                         '<xf numFmtId="22"/></cellXfs></styleSheet>',
        "xl/worksheets/s.xml": f"<worksheet {MAIN_XML}><sheetData><row>{header}</row>{body}"
                               "</sheetData></worksheet>",
    }
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as book:
        for name, text in parts.items():
            book.writestr(name, text)
    return buffer.getvalue()


def _workbooks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"path": ["lines.xlsx"], "content": [workbook(batch)]})


def _xlsx(s, d) -> DataFrame:
    """The lines packed into workbooks, one per Arrow batch, and scanned again."""
    lines = raw(s, d)
    books = lines.mapInPandas(_workbooks, "path string, content binary")
    return typed(without_missing_tokens(workbook_rows(books, lines.columns)))


def _arrivals(s, d, folder: str, **options):
    """Lines that arrive in three parts, the newest dates first: a stream after each part.

    The last part repeats invoices of the others, so copies lie in different micro-batches.
    What is not read again is deleted: all lines when the last part is written, and a part when
    the next one is asked for, as its stream has ended then.
    """
    lines = _laid_down(raw(s, d), f"{folder}/todas")
    cuts = lines.agg(F.percentile_approx(F.col("InvoiceDate").cast("timestamp").cast("long"),
                                         F.lit([0.33, 0.66]))).scalar()
    day = F.col("InvoiceDate").cast("timestamp").cast("long")
    parts = (lines.where(day >= cuts[1]), lines.where((day >= cuts[0]) & (day < cuts[1])),
             lines.where((day < cuts[0]) | F.col("InvoiceNo").endswith("3")))
    for number, part in enumerate(parts, 1):
        part.write.option("compression", "zstd").parquet(f"{folder}/llegadas/{number}")
        if number == len(parts):
            remove_folder(s, f"{folder}/todas")
        yield s.readStream.schema(lines.schema).options(**options).parquet(f"{folder}/llegadas/*")
        remove_folder(s, f"{folder}/llegadas/{number}")


def _clean_stream(s, d) -> DataFrame:
    """The lines cleaned as they arrive, within the watermark, and appended.

    All that has arrived is cleaned; a batch's share of it bounds what is shuffled at a time.
    """
    folder = fresh_folder(s)
    for arriving in _arrivals(s, d, folder, maxBytesPerTrigger=BYTES_PER_BATCH):
        with state_on_disk(s):
            stream = clean_stream(arriving).writeStream.format("parquet").option(
                "compression", "zstd").option("path", f"{folder}/lineas").option(
                "checkpointLocation", f"{folder}/estado").trigger(availableNow=True).start()
            stream.awaitTermination()
    remove_folder(s, f"{folder}/estado")
    return s.read.parquet(f"{folder}/lineas")


def _clean_exactly(s, d) -> DataFrame:
    """The lines cleaned as they arrive, against the stored index of all lines before them."""
    folder = fresh_folder(s)
    for arriving in _arrivals(s, d, folder):
        clean_lines_as_they_come(arriving, folder, f"{folder}/estado", merged=2).awaitTermination()
    return read_clean_lines(s, folder)


def _file_drop(s, d) -> DataFrame:
    """Key figures of the tables reloaded from the line items that arrived."""
    folder = fresh_folder(s)

    def job(spark, paths, warehouse):
        tables = order_tables(spark, d)
        arrived = spark.read.schema(tables["lineitem"].schema).parquet(*paths)
        lines = lines_of(tables | {"lineitem": arrived})
        store_tables(store_clean(lines, warehouse), warehouse)

    watch_landing(s, f"{d}/lineitem.parq*", folder, f"{folder}/estado",
                  job=job).awaitTermination()
    return plain(kpis(read_stored(s, folder, "ventas"), read_stored(s, folder, "productos")))


def _load_checks(s, d) -> DataFrame:
    """What a load says to files it must refuse, one row per case: A3 to A5 and H4."""
    folder = fresh_folder(s)
    lines = _laid_down(raw(s, d), f"{folder}/lineas")
    _write_csv(lines, f"{folder}/whole.csv")
    _write_csv(lines.drop("UnitPrice", "StockCode"), f"{folder}/fewer.csv")
    _write_csv(lines.select("UnitPrice", "Quantity", *[
        c for c in lines.columns if c not in ("UnitPrice", "Quantity")]), f"{folder}/other.csv")

    def outcome(*names) -> str:
        try:
            loaded = load_dataset(s, [f"{folder}/{n}" for n in names])
            return str(loaded.agg(F.count("Quantity")).first()[0])  # a count of rows reads no column
        except FileNotFoundError as error:
            return f"missing file: {os.path.basename(str(error))}"
        except ValueError as error:
            return str(error).split(" use ")[0]
        except Exception:  # the reader's own report of a header that differs
            return "stopped"

    cases = {"whole": ("whole.csv",), "extension": ("whole.txt",), "no file": ("none.csv",),
             "columns": ("fewer.csv",), "other order": ("other.csv",),
             "two orders": ("whole.csv", "other.csv")}
    return s.createDataFrame([(c, outcome(*names)) for c, names in cases.items()],
                             "caso string, resultado string")


def _whole_job(s, d) -> str:
    """The reload of a written file, as the command line runs it; the folder of its tables."""
    folder = fresh_folder(s)
    _write_csv(raw(s, d), f"{folder}/lineas.csv")
    reload(s, f"{folder}/lineas.csv", f"{folder}/tablas")
    return f"{folder}/tablas"


def _reload_forecast(s, d) -> DataFrame:
    """The forecast file of the whole job."""
    months = s.read.option("header", True).schema(
        "series_key string, fecha date, ventas_reales double, ventas_predichas double").csv(
        f"{current(s, _whole_job(s, d))}/predicciones_ridge")
    return rounded(months, "ventas_reales", "ventas_predichas", digits=4)


def _reload_metrics(s, d) -> DataFrame:
    return rounded(read_metrics(s, _whole_job(s, d)), "rmse", "mae", "r2", digits=4)


def _reload_audit(s, d) -> DataFrame:
    return read_audit(s, _whole_job(s, d))


def _reload_plan(s, d) -> DataFrame:
    """Forecast rows of the whole job: real ridge units, whole numbers, spread over products."""
    stored_rows = read_stored(s, _whole_job(s, d), "predicciones")
    return plain(stored_rows.select("id_producto", "fecha_prediccion", "unidades_predichas",
                                    "unidades_vendidas",
                                    (F.col("id_prediccion") > 0).alias("con_clave")))


QUERIES = {
    "insert_ignore": lambda s, d: plain(_insert_ignore(s, d)),
    "insert_ignore_stored": _stored_products,
    "surrogate_key": _surrogate_key,
    "sales_keys": _sales_keys,
    "clear_tables": _cleared,
    "constraint_violations": _violations,
    "broken_rows": lambda s, d: plain(_broken(s, d)),
    "duplicate_keys": lambda s, d: k.duplicate_keys(clean(s, d), "id_producto"),
    "orphans": lambda s, d: k.orphans(_unfiltered_facts(s, d), productos(s, d)),
    "rows_of_known_products": _known,
    "rows_set_aside": _set_aside,
    "null_safe_round_cast": _null_safe,
    "clean_table": _clean_table,
    "reloaded_kpis": _reloaded,
    "model_table_forecast": _model_table,
    "csv_roundtrip": _csv,
    "lenient_load": _lenient,
    "xlsx_scan": _xlsx,
    "clean_stream": _clean_stream,
    "clean_stream_exact": _clean_exactly,
    "file_drop_stream": _file_drop,
    "stored_sales_last_30d": _stored_recent,
    "stored_monthly_last_year": _stored_months,
    "load_checks": _load_checks,
    "reload_forecast": _reload_forecast,
    "reload_metrics": _reload_metrics,
    "reload_audit": _reload_audit,
    "reload_plan": _reload_plan,
}

_FACTS = ("facts", """
    SELECT "InvoiceNo" AS id_venta_original, upper(trim("StockCode")) AS id_producto,
        CAST("InvoiceDate" AS DATE) AS fecha_venta, "Quantity" AS unidades_vendidas,
        round_even("Quantity" * "UnitPrice" * 100, 0) / 100 AS total_venta
    FROM raw""")

_NEW = """
    SELECT id_producto, nombre, 'Sin categoría' AS categoria, precio_unitario FROM (
        SELECT *, row_number() OVER (PARTITION BY id_producto
            ORDER BY nombre, precio_unitario) AS puesto FROM clean
        WHERE id_producto NOT IN (SELECT id_producto FROM productos))
    WHERE puesto = 1"""

_ZERO_RULES = (
    ("productos", ("id_producto not null", "nombre not null", "precio_unitario not null",
                   "precio_unitario decimal(10,2)", "id_producto varchar(20)",
                   "nombre varchar(255)", "categoria varchar(100)",
                   "id_producto primary key")),
    ("ventas", ("fecha_venta not null", "unidades_vendidas not null", "total_venta not null",
                "total_venta decimal(10,2)", "id_venta_original varchar(20)",
                "id_producto varchar(20)", "id_venta primary key")),
    ("predicciones", ("fecha_prediccion not null", "confianza_modelo decimal(5,4)",
                      "id_producto varchar(20)", "id_producto references productos",
                      "id_prediccion primary key")),
)

_HOLDS = " UNION ALL ".join(
    f"SELECT '{table}' AS tabla, '{rule}' AS restriccion, CAST(0 AS BIGINT) AS filas"
    for table, rules in _ZERO_RULES for rule in rules)

_KPIS = """
    SELECT CAST(coalesce(sum(total_venta), 0) AS DOUBLE) AS ventas_totales,
        CAST(coalesce(sum(unidades_vendidas), 0) AS BIGINT) AS unidades_totales,
        (SELECT count(*) FROM productos) AS productos_distintos
    FROM ventas"""

ORACLES = {
    "insert_ignore": sql(STORED, _NEW),
    "insert_ignore_stored": sql(STORED, f"""
        SELECT * REPLACE (CAST(precio_unitario AS DOUBLE) AS precio_unitario) FROM productos
        UNION ALL ({_NEW})"""),
    "surrogate_key": sql(PLANNED, """
        SELECT row_number() OVER (ORDER BY id_producto NULLS FIRST, fecha_prediccion)
            AS id_prediccion,
            * REPLACE (CAST(confianza_modelo AS DOUBLE) AS confianza_modelo)
        FROM predicciones"""),
    "sales_keys": sql(LINES, """
        SELECT count(*) AS filas, TRUE AS positivas, count(*) AS claves, CAST(sum(unidades_vendidas) AS BIGINT) AS unidades,
            CAST(sum(CAST(total_venta AS DECIMAL(10,2))) AS DOUBLE) AS total
        FROM clean"""),
    "clear_tables": sql(STORED, """
        SELECT count(*) AS cargadas, CAST(0 AS BIGINT) AS quedan FROM ventas"""),
    "constraint_violations": sql((*PLANNED, _FACTS), f"""
        {_HOLDS}
        UNION ALL SELECT 'ventas', 'unidades_vendidas > 0',
            (SELECT count(*) FROM facts WHERE unidades_vendidas <= 0)
        UNION ALL SELECT 'ventas', 'id_producto references productos',
            (SELECT count(*) FROM facts
             WHERE id_producto NOT IN (SELECT id_producto FROM productos))"""),
    "broken_rows": sql((*LINES, _FACTS), """
        SELECT *, 'unidades_vendidas > 0' AS restricciones FROM facts
        WHERE unidades_vendidas <= 0"""),
    "duplicate_keys": sql(LINES, """
        SELECT id_producto, count(*) AS filas FROM clean GROUP BY ALL HAVING count(*) > 1"""),
    "orphans": sql((*STORED, _FACTS), """
        SELECT id_producto, count(*) AS filas FROM facts
        WHERE id_producto NOT IN (SELECT id_producto FROM productos) GROUP BY ALL"""),
    "rows_of_known_products": sql((*STORED, _FACTS), """
        SELECT * FROM facts WHERE id_producto IN (SELECT id_producto FROM productos)"""),
    "rows_set_aside": sql((*STORED, _FACTS), """
        SELECT * FROM facts WHERE id_producto NOT IN (SELECT id_producto FROM productos)"""),
    "null_safe_round_cast": sql(PLANNED, """
        SELECT id_producto, fecha_prediccion,
            CAST(round_even(unidades_predichas / 4, 0) AS BIGINT) AS unidades_predichas,
            CAST(round_even(unidades_vendidas / 8, 0) AS BIGINT) AS unidades_vendidas,
            CASE WHEN month(fecha_prediccion) % 2 = 0 THEN CAST(0.8765 AS DOUBLE) END
                AS confianza_modelo
        FROM predicciones"""),
    "clean_table": sql(LINES, "SELECT * FROM clean"),
    "reloaded_kpis": sql(STORED, _KPIS),
    "model_table_forecast": MODEL_ORACLES["forecast_next_year"],
    "csv_roundtrip": sql(LINES, "SELECT * FROM raw"),
    "lenient_load": sql(LINES, """
        SELECT count(*) FILTER ("Country" <> 'NATION_3') AS buenas,
            CAST(sum("Quantity") FILTER ("Country" <> 'NATION_3') AS BIGINT) AS unidades,
            count(*) FILTER ("Country" = 'NATION_3') AS apartadas
        FROM raw"""),
    "xlsx_scan": sql(LINES, "SELECT * FROM raw"),
    "clean_stream": sql(LINES, "SELECT * FROM clean"),
    "clean_stream_exact": sql(LINES, "SELECT * FROM clean"),
    "load_checks": """
        SELECT * FROM (VALUES
            ('whole', (SELECT CAST(count(*) AS VARCHAR) FROM ({rows}))),
            ('extension', 'unsupported format ''.txt'':'),
            ('no file', 'missing file: none.csv'),
            ('columns', 'missing required columns: StockCode, UnitPrice'),
            ('other order', (SELECT CAST(count(*) AS VARCHAR) FROM ({rows}))),
            ('two orders', (SELECT CAST(2 * count(*) AS VARCHAR) FROM ({rows})))
            ) c(caso, resultado)""".format(
        rows=sql(LINES, "SELECT 1 FROM raw")),
    "reload_forecast": MODEL_ORACLES["forecast_next_year"],
    "reload_metrics": MODEL_ORACLES["backtest_metrics"],
    "reload_audit": f"""
        SELECT orden, paso, filas FROM ({LINES_ORACLES["clean_audit"]})
        UNION ALL SELECT orden + 5, medida, filas FROM ({CATALOG_ORACLES["split_counts"]})""",
    "file_drop_stream": sql(STORED, _KPIS),
    "reload_plan": RIDGE_PLAN,
    "stored_sales_last_30d": SERVING_ORACLES["sales_last_30d_all"],
    "stored_monthly_last_year": SERVING_ORACLES["monthly_units_last_year"],
}
