"""Exact cleaning of a stream of invoice lines: copies go whenever they arrive.

An index of 128-bit hashes of all lines kept so far lies in a shared folder, partitioned by
invoice month. A micro-batch is cleaned like a table and joined with the months of the index
that it touches. What a batch writes lies in folders of its number, so a batch that is
repeated after a failure writes the same again; it reads only the folders of smaller numbers.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from surtido.functions import month_start, row_hash
from surtido.operators.cleaning import drop_exact_duplicates, keep_sales, normalize_lines
from surtido.session import list_folder, remove_folder

# Index folders that are merged into one of the next level, so few are open at a time.
MERGED = 16
INDEX = "h1 bigint, h2 bigint, nivel int, lote bigint, mes date"
# The month of lines without a date, which a partition of files cannot have.
NO_MONTH = "0001-01-01"


def line_hash(columns: list[str], salt: int) -> Column:
    """64 bits of a line."""
    return row_hash([F.col(f"`{c}`") for c in columns], salt)


def open_folders(batch: int, merged: int = MERGED) -> list[tuple[int, int]]:
    """(level, number) of the index folders that hold all batches before ``batch``.

    Like the digits of the batch's number: a folder of level 1 holds ``merged`` batches, one
    of level 2 as many folders of level 1.
    """
    found, level, done = [], 0, batch
    while done:
        done, rest = divmod(done, merged)
        found += [(level, done * merged + k) for k in range(rest)]
        level += 1
    return found


def _index(spark: SparkSession, folder: str, folders: list[tuple[int, int]]) -> DataFrame:
    chosen = F.lit(False)
    for level, number in folders:
        chosen |= (F.col("nivel") == level) & (F.col("lote") == number)
    if not list_folder(spark, f"{folder}/indice"):
        return spark.createDataFrame([], INDEX)
    return spark.read.schema(INDEX).option("basePath", f"{folder}/indice").parquet(
        f"{folder}/indice").where(chosen)


def _write_index(rows: DataFrame, folder: str, level: int, number: int) -> None:
    rows.select("h1", "h2", "mes").write.mode("overwrite").partitionBy("mes").parquet(
        f"{folder}/indice/nivel={level}/lote={number}")


def merge_index(spark: SparkSession, folder: str, batch: int, merged: int = MERGED) -> None:
    """Write the folders that end before ``batch`` as one of the next level, where one is full.

    The parts stay until the next merge, so that a repeated batch finds them.
    """
    level, number = 0, batch
    while number and number % merged == 0:
        parts = [(level, k) for k in range(number - merged, number)]
        _write_index(_index(spark, folder, parts), folder, level + 1, number // merged - 1)
        for k in range(max(0, number - 2 * merged), number - merged):
            remove_folder(spark, f"{folder}/indice/nivel={level}/lote={k}")
        level, number = level + 1, number // merged


def clean_batch(batch: DataFrame, folder: str, number: int, merged: int = MERGED) -> None:
    """Append the lines of a batch that no earlier line equals, cleaned, to ``folder/lineas``."""
    spark, columns = batch.sparkSession, batch.columns
    month = F.coalesce(month_start(F.to_date("InvoiceDate")), F.lit(NO_MONTH).cast("date"))
    merge_index(spark, folder, number, merged)
    lines = drop_exact_duplicates(keep_sales(batch)).withColumns({
        "h1": line_hash(columns, 1), "h2": line_hash(columns, 2), "mes": month})
    # The batch is read once: its lines are written and read again for the join.
    aside = f"{folder}/_lote"
    lines.write.mode("overwrite").parquet(aside)
    lines = spark.read.schema(lines.schema).parquet(aside)
    touched = lines.select(F.col("mes").cast("string").alias("mes")).distinct().collect()
    months = [F.lit(r["mes"]).cast("date") for r in touched]  # as many as the calendar has
    known = _index(spark, folder, open_folders(number, merged)).where(F.col("mes").isin(months))
    new = lines.join(known.select("mes", "h1", "h2"), ["mes", "h1", "h2"], "left_anti")
    normalize_lines(new.select(*columns)).write.mode("overwrite").parquet(
        f"{folder}/lineas/lote={number}")
    # Hashes of lines that were known are written again; the join does not mind.
    _write_index(lines, folder, 0, number)


def clean_lines_as_they_come(raw: DataFrame, folder: str, checkpoint: str,
                             merged: int = MERGED, **trigger) -> StreamingQuery:
    """Clean a stream of lines into ``folder``: the same rows as cleaning all lines at once.

    Of equal lines the first that arrives stays, however far apart they arrive. ``trigger``
    are the options of the stream's trigger; without, all that has arrived is cleaned.
    """
    return (
        raw.writeStream
        .foreachBatch(lambda batch, number: clean_batch(batch, folder, number, merged))
        .option("checkpointLocation", os.path.join(checkpoint, "lineas"))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_clean_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All lines that the stream has cleaned."""
    return spark.read.parquet(f"{folder}/lineas").drop("lote")
