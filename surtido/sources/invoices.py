"""Invoice lines derived from an order data set (lineitem, orders, part, customer, nation).

The tables hold no cancelled lines, nulls or copies; the rules below add them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surtido.functions import money_round


# Given, so that planning opens no file.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
}


def order_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: spark.read.schema(schema).parquet(f"{folder}/{name}.parquet")
            for name, schema in SCHEMAS.items()}


def invoice_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Raw invoice lines; every line of an invoice whose number ends in 7 comes twice."""
    return lines_of(order_tables(spark, folder))


# What the flags and rates of a line item say, as bits of one small number.
CANCELLED, RETURNED, FREE = 1, 2, 4


def _marks(told: dict[int, Column]) -> Column:
    return reduce(Column.bitwiseOR, [F.when(c, bit).otherwise(0) for bit, c in told.items()])


def _has(bit: int) -> Column:
    return F.col("_marcas").bitwiseAND(F.lit(bit)) > 0


def lines_of(tables: dict[str, DataFrame]) -> DataFrame:
    """The same from given tables; ``lineitem`` may be a stream.

    What travels is narrow: the orders get their customer before they meet the items, of which
    the flags go as one number, and the texts of the parts and nations come last, when the
    lines travel no more.
    """
    flag, tax = F.col("l_returnflag"), F.col("l_tax")
    items = tables["lineitem"].select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate",
        _marks({CANCELLED: (flag == "R") & (tax == 0), RETURNED: (flag == "A") & (tax == 0),
                FREE: (F.col("l_discount") == 0) & (flag == "N")}).cast("byte").alias("_marcas"))
    buyers = tables["orders"].join(
        tables["customer"], F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_custkey", "c_nationkey")
    parts = tables["part"].select(
        "p_partkey",
        F.concat(F.lower("p_brand"), F.lit("-"), "p_type", F.lit(" ")).alias("StockCode"),
        F.when(F.col("p_size") != 1, F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("Description"))
    lines = (
        items
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(tables["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    )
    quantity = F.col("l_quantity").cast("int")
    invoice = F.col("l_orderkey").cast("string")
    return lines.select(
        F.when(_has(CANCELLED), F.concat(F.lit("C"), invoice)).otherwise(invoice).alias("InvoiceNo"),
        "StockCode", "Description",
        F.when(_has(RETURNED), -quantity).otherwise(quantity).alias("Quantity"),
        F.col("l_shipdate").alias("InvoiceDate"),
        F.when(_has(FREE), F.lit(0.0))
        .otherwise(money_round(F.col("l_extendedprice") / F.col("l_quantity"))).alias("UnitPrice"),
        F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey").cast("double")).alias("CustomerID"),
        F.col("n_name").alias("Country"),
        F.explode(F.when(F.col("l_orderkey") % 10 == 7, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
