"""Table sinks: full reload, insert-or-ignore, appends, emptying."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from surtido.constants import INSERT_BATCH
from surtido.operators.allocation import to_forecast_rows
from surtido.functions import month_start
from surtido.schemas import SALES, STORED, to_stored
from surtido.sinks.keys import dense_key


# Parquet's filter of the values of a column, sized for the products of a file.
PRODUCT_FILTER = {
    "parquet.bloom.filter.enabled#id_producto": "true",
    "parquet.bloom.filter.expected.ndv#id_producto": "20000",
}


def clear_tables(spark: SparkSession, warehouse: str) -> None:
    """Create the stored tables where they are missing and empty them, facts first."""
    for table in ("predicciones", "productos"):
        empty = spark.createDataFrame([], STORED[table])
        empty.write.mode("overwrite").parquet(f"{warehouse}/{table}")
    sales = spark.createDataFrame([], SALES)
    sales.write.mode("overwrite").partitionBy("mes").parquet(f"{warehouse}/ventas")
    newest = spark.createDataFrame([], "id_producto string, ultima date")
    newest.write.mode("overwrite").parquet(f"{warehouse}/ultimas_ventas")


def missing_products(productos: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows to insert: keys the table lacks, one row per key.

    Among incoming rows of one key the least one is taken, so a repeated run inserts the
    same row. The reduction is an aggregate, partial before the shuffle.
    """
    others = [c for c in productos.columns if c != "id_producto"]
    one = productos.groupBy("id_producto").agg(F.min(F.struct(*others)).alias("fila"))
    return one.join(stored.select("id_producto"), "id_producto", "left_anti").select(
        "id_producto", "fila.*")


def insert_ignore(productos: DataFrame, warehouse: str) -> None:
    """Insert products, ignoring those whose key is stored already."""
    path = f"{warehouse}/productos"
    stored = productos.sparkSession.read.schema(STORED["productos"]).parquet(path)
    new = missing_products(to_stored(productos, "productos"), stored)
    new.write.mode("append").parquet(path)


def sales_key() -> Column:
    """A key above 0 that tells the rows of one writing pass apart; not dense."""
    return (F.monotonically_increasing_id() + 1).alias("id_venta")


def append_sales(ventas: DataFrame, warehouse: str) -> None:
    """Append sales to the emptied table, each with a key of its own, in one pass.

    A key tells rows apart; it is above 0 and need not be dense, so no row is written twice
    to be counted. The table has a folder per month, and a file holds a range of products:
    reads of recent days skip old months, reads of one product skip most files. A product
    that holds much of a month is split over files by its days. A Bloom filter of the products
    of every row group skips files whose range holds the product, but which lack it. The newest sale of every
    product is stored beside, so that a read knows the oldest month it needs.
    """
    order = ["mes", "id_producto", "fecha_venta"]
    rows = to_stored(ventas, "ventas").withColumn("mes", month_start(F.col("fecha_venta")))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    keyed = rows.select(sales_key(), "*")
    keyed.write.mode("append").partitionBy("mes").options(**PRODUCT_FILTER).parquet(
        f"{warehouse}/ventas")
    stored = ventas.sparkSession.read.schema(SALES).parquet(f"{warehouse}/ventas")
    newest = stored.groupBy("id_producto").agg(F.max("fecha_venta").alias("ultima"))
    newest.write.mode("overwrite").parquet(f"{warehouse}/ultimas_ventas")


def append_forecasts(allocated: DataFrame, warehouse: str) -> None:
    """Append forecast rows to the emptied table; no rows, no effect."""
    order = [F.asc_nulls_first("id_producto"), "fecha_prediccion"]
    numbered = dense_key(to_forecast_rows(allocated), "id_prediccion", order)
    to_stored(numbered, "predicciones").write.mode("append").parquet(f"{warehouse}/predicciones")


def write_jdbc(df: DataFrame, url: str, table: str, reload: bool = True,
               batch_size: int = INSERT_BATCH, **options: str) -> DataFrameWriter:
    """Writer for a database whose driver is on the class path; call ``save()`` on it.

    A reload empties the table and keeps its definition.
    """
    return (
        df.write.format("jdbc").mode("overwrite" if reload else "append")
        .option("url", url).option("dbtable", table)
        .option("truncate", reload).option("batchsize", batch_size)
        .options(**options)
    )
