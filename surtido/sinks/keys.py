"""Surrogate keys without gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surtido.session import ensure_checkpoint_dir

# monotonically_increasing_id holds the row number of a partition in its low 33 bits.
ROW_MASK = (1 << 33) - 1


def dense_key(df: DataFrame, name: str, order: Sequence[str | Column] = ()) -> DataFrame:
    """Add ``name``: 1, 2, 3, … in the given order, or in the order the rows lie in.

    A window over all rows would put them in one task. Here every partition numbers its
    own rows, and the running total of the row counts (one row per partition) tells where
    each starts. With ``order`` a distributed sort cuts the rows into ranges first; the
    order columns should tell rows apart, since equal ones share a range. Without it
    nothing is shuffled, whatever the rows repeat. The rows are checkpointed in the shared
    folder before they are numbered, so a lost executor cannot number them differently.
    """
    ensure_checkpoint_dir(df.sparkSession)
    columns = df.columns
    fixed = (df.orderBy(*order) if order else df).checkpoint()
    placed = fixed.withColumns({
        "_parte": F.spark_partition_id(),
        "_fila": F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_MASK)),
    })
    counts = placed.groupBy("_parte").agg(F.count(F.lit(1)).alias("_filas"))
    before = Window.orderBy("_parte").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(
        "_parte", F.coalesce(F.sum("_filas").over(before), F.lit(0)).alias("_antes"))
    # One row per partition; the planner broadcasts it while its measured size allows.
    numbered = placed.join(first, "_parte")
    return numbered.select((F.col("_antes") + F.col("_fila") + 1).alias(name), *columns)
