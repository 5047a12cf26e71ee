"""Readers of the tables the jobs write."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surtido.functions import month_start
from surtido.operators.cleaning import COPIES, STEP
from surtido.schemas import SALES, STORED
from surtido.versions import current

# The readers open the version of the tables that holds when they are called. Several tables
# that must fit together are read from one ``current`` folder.


def read_clean(spark: SparkSession, warehouse: str) -> DataFrame:
    """The clean lines, without the rows that only count what cleaning removed."""
    lines = spark.read.parquet(f"{current(spark, warehouse)}/ventas_limpias")
    if STEP not in lines.columns:
        return lines
    return lines.where(F.col(STEP) == 0).drop(STEP, COPIES)


def read_audit(spark: SparkSession, warehouse: str) -> DataFrame:
    return spark.read.parquet(f"{current(spark, warehouse)}/auditoria")


def read_stored(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """A stored table. The schema is given, so no file is opened to plan the scan."""
    schema = SALES if table == "ventas" else STORED[table]
    stored = spark.read.schema(schema).parquet(f"{current(spark, warehouse)}/{table}")
    return stored.select(*STORED[table].names)


def read_recent_sales(spark: SparkSession, warehouse: str, days: int = 0,
                      months: int = 0) -> DataFrame:
    """The stored sales of the months that the last days or months of any product reach into.

    The oldest newest sale of a product tells where to begin; older months are not opened.
    """
    folder = current(spark, warehouse)
    newest = spark.read.schema("id_producto string, ultima date").parquet(
        f"{folder}/ultimas_ventas")
    first = month_start(F.add_months(F.date_sub(F.min("ultima"), days), -months))
    sales = spark.read.schema(SALES).parquet(f"{folder}/ventas")
    return sales.where(F.col("mes") >= newest.agg(first).scalar()).select(*STORED["ventas"].names)


def read_model(spark: SparkSession, warehouse: str) -> DataFrame:
    return spark.read.parquet(f"{current(spark, warehouse)}/modelo")


def read_metrics(spark: SparkSession, warehouse: str) -> DataFrame:
    return spark.read.parquet(f"{current(spark, warehouse)}/metricas")


def bounds_query(table: str, column: str, parts: int) -> str:
    """One row of at most ``parts - 1`` values that cut a column into parts of about equal size.

    It is the database's own quantile, so values that repeat or leave gaps do not matter.
    """
    cuts = ", ".join(
        f"percentile_disc({k / parts!r}) WITHIN GROUP (ORDER BY {column}) AS c{k}"
        for k in range(1, parts))
    return f"SELECT {cuts} FROM {table}"


def _literal(value) -> str:
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def range_predicates(column: str, cuts: Sequence) -> list[str]:
    """Predicates that give every row, also one without a value, to exactly one part.

    Equal cuts, as a value that many rows share gives, make one part of it.
    """
    cuts = sorted({c for c in cuts if c is not None})
    if not cuts:
        return ["1 = 1"]
    texts = [_literal(c) for c in cuts]
    first = f"{column} < {texts[0]} OR {column} IS NULL"
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(texts, texts[1:])]
    return [first, *inner, f"{column} >= {texts[-1]}"]


def read_jdbc(spark: SparkSession, url: str, table: str, split_by: str | None = None,
              parts: int = 16, **options: str) -> DataFrame:
    """A stored table of a database whose driver is on the class path.

    With ``split_by`` the table is read by ``parts`` tasks, each a range of that column, cut
    where the database's quantiles lie; one small query asks for these. Without, by one task.
    """
    if split_by is None or parts < 2:
        return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    cuts = spark.read.format("jdbc").options(
        url=url, query=bounds_query(table, split_by, parts), **options).load().first()
    return spark.read.jdbc(url, table, predicates=range_predicates(split_by, list(cuts)),
                           properties=dict(options))
