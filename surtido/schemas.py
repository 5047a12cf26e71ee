"""Schemas of the raw, clean and stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surtido.constants import DEFAULT_CATEGORY

MONEY = T.DecimalType(10, 2)
CONFIDENCE = T.DecimalType(5, 4)

PRODUCTOS = T.StructType([
    T.StructField("id_producto", T.StringType(), False),
    T.StructField("nombre", T.StringType(), False),
    T.StructField("categoria", T.StringType(), True),
    T.StructField("precio_unitario", MONEY, False),
])

VENTAS = T.StructType([
    T.StructField("id_venta", T.LongType(), False),
    T.StructField("id_venta_original", T.StringType(), True),
    T.StructField("id_producto", T.StringType(), True),
    T.StructField("fecha_venta", T.DateType(), False),
    T.StructField("unidades_vendidas", T.IntegerType(), False),
    T.StructField("total_venta", MONEY, False),
])

PREDICCIONES = T.StructType([
    T.StructField("id_prediccion", T.LongType(), False),
    T.StructField("id_producto", T.StringType(), True),
    T.StructField("fecha_prediccion", T.DateType(), False),
    # Wider than the four bytes of a database INT: a month of all units passes 2**31 at scale.
    T.StructField("unidades_predichas", T.LongType(), True),
    T.StructField("unidades_vendidas", T.LongType(), True),
    T.StructField("confianza_modelo", CONFIDENCE, True),
])

# The sales as they lie in the warehouse, in a folder per month.
SALES = T.StructType([*VENTAS, T.StructField("mes", T.DateType(), True)])

STORED = {"productos": PRODUCTOS, "ventas": VENTAS, "predicciones": PREDICCIONES}

# Longest text each stored column takes.
MAX_LENGTH = {
    "productos": {"id_producto": 20, "nombre": 255, "categoria": 100},
    "ventas": {"id_venta_original": 20, "id_producto": 20},
    "predicciones": {"id_producto": 20},
}


def to_stored(df: DataFrame, table: str) -> DataFrame:
    """Columns of ``df`` that ``table`` has, in table order and with stored types.

    A missing category takes its default. Casts are strict: a value that does not fit (say, too many digits) stops the job.
    """
    if table == "productos" and "categoria" not in df.columns:
        df = df.withColumn("categoria", F.lit(DEFAULT_CATEGORY))
    present = set(df.columns)
    columns: list[Column] = [
        F.col(field.name).cast(field.dataType).alias(field.name)
        for field in STORED[table]
        if field.name in present
    ]
    return df.select(*columns)
