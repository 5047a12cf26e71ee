"""Cleaning of raw invoice lines.

Filters and projections are stateless and take streaming DataFrames as well; exact
duplicate removal is the only shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surtido.constants import INTERNAL_NAMES, MISSING_CODE, MISSING_DESCRIPTION
from surtido.functions import is_cancelled, money_round, row_hash, strip_upper
from surtido.session import send_to_workers

send_to_workers(__name__)


def drop_cancelled(lines: DataFrame) -> DataFrame:
    return lines.filter(~is_cancelled(F.col("InvoiceNo")))


def keep_positive(lines: DataFrame) -> DataFrame:
    """Lines with a quantity and a price above zero; missing ones (null, NaN) go."""
    return lines.filter(
        (F.col("Quantity") > 0) & (F.col("UnitPrice") > 0) & ~F.isnan("UnitPrice")
    )


def drop_exact_duplicates(lines: DataFrame) -> DataFrame:
    """Distinct raw lines, over every column and before any of them is normalised.

    Spark drops copies inside each input partition before the shuffle, so a line that
    makes up a large part of the data leaves one row per task.
    """
    return lines.dropDuplicates()


def fill_missing(lines: DataFrame) -> DataFrame:
    """Fill descriptions and customers; lines without a product code share one of their own."""
    customer = F.col("CustomerID") if "CustomerID" in lines.columns else F.lit(None)
    return lines.withColumns({
        "StockCode": F.coalesce(F.col("StockCode").cast("string"), F.lit(MISSING_CODE)),
        "Description": F.coalesce(F.col("Description"), F.lit(MISSING_DESCRIPTION)),
        "CustomerID": F.coalesce(customer.cast("double"), F.lit(0.0)).cast("bigint"),
    })


def normalize_dates(lines: DataFrame) -> DataFrame:
    return lines.withColumn("InvoiceDate", F.to_date("InvoiceDate"))


def normalize_text(lines: DataFrame) -> DataFrame:
    return lines.withColumns({
        "Description": strip_upper(F.col("Description")),
        "StockCode": strip_upper(F.col("StockCode")),
    })


def add_line_total(lines: DataFrame) -> DataFrame:
    return lines.withColumn("total_venta", money_round(F.col("Quantity") * F.col("UnitPrice")))


def to_internal_names(lines: DataFrame) -> DataFrame:
    return lines.withColumnsRenamed(INTERNAL_NAMES)


def keep_sales(lines: DataFrame) -> DataFrame:
    """The row filters that precede duplicate removal."""
    return keep_positive(drop_cancelled(lines))


# The step that drops a line, 0 for those that stay, and how many equal raw lines a row is.
STEP = "_paso"
COPIES = "_copias"


def dropped_at() -> Column:
    """1 for cancelled lines, 2 for no quantity above zero, 3 for no price, 0 for the others."""
    some = F.coalesce(F.col("Quantity") > 0, F.lit(False))
    priced = F.coalesce((F.col("UnitPrice") > 0) & ~F.isnan("UnitPrice"), F.lit(False))
    return F.when(is_cancelled(F.col("InvoiceNo")), 1).when(~some, 2).when(~priced, 3).otherwise(0)


def count_copies(raw: DataFrame) -> DataFrame:
    """The distinct sold lines with their number of copies, and a row for each dropping step.

    One aggregate removes the duplicates and counts everything that cleaning removes: dropped
    lines lose their values, so those of a step are one group inside every task. The counts
    travel and are written with the rows, so a repeated task cannot count twice.
    """
    tagged = raw.withColumn(STEP, dropped_at())
    held = [F.when(F.col(STEP) == 0, raw[f"`{c}`"]).alias(c) for c in raw.columns]
    return tagged.select(*held, STEP).groupBy(*[f"`{c}`" for c in raw.columns], STEP).agg(
        F.count(F.lit(1)).alias(COPIES))


def normalize_lines(lines: DataFrame) -> DataFrame:
    """The projections that follow duplicate removal."""
    steps = (fill_missing, normalize_dates, normalize_text, add_line_total, to_internal_names)
    for step in steps:
        lines = step(lines)
    return lines


def clean_lines(raw: DataFrame) -> DataFrame:
    """Raw invoice lines to clean sales lines; columns not used here ride along."""
    return normalize_lines(drop_exact_duplicates(keep_sales(raw)))


ARRIVED = "_llegada"
# The 128 bits that stand for the values of a line in the state.
HASHES = ("_huella1", "_huella2")
HASHED = (T.StringType, T.BinaryType, T.BooleanType, T.NumericType, T.DateType, T.TimestampType,
          T.TimestampNTZType)


def _once_a_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct rows of every Arrow batch; columns that Arrow cannot compare stay as they are."""
    for batch in batches:
        try:
            rows = pa.Table.from_batches([batch])
            yield from rows.group_by(rows.column_names, use_threads=False).aggregate(
                []).select(rows.column_names).cast(batch.schema).to_batches()
        except (pa.ArrowNotImplementedError, pa.ArrowKeyError):
            yield batch


def _with_hashes(lines: DataFrame) -> tuple[DataFrame, list[str]]:
    """The lines with their hashes, and the columns that tell one line from another.

    Nested values stay columns of their own: hashes run over their elements, so they are the same
    for arrays that share them out otherwise. A zero is hashed with its sign.
    """
    plain = [f for f in lines.schema if isinstance(f.dataType, HASHED)]
    values = [F.col(f"`{f.name}`") for f in plain]
    signs = [F.when(v == 0, v.cast("string")) for f, v in zip(plain, values)
             if isinstance(f.dataType, T.FractionalType) and not isinstance(f.dataType, T.DecimalType)]
    nested = [f.name for f in lines.schema if f not in plain]
    return lines.withColumns({
        name: row_hash(values + signs, salt) for salt, name in enumerate(HASHES, 1)
    }), [*HASHES, *nested]


def clean_stream(raw: DataFrame, lateness: str = "1 day") -> DataFrame:
    """The same cleaning for a stream of lines, whatever the order of their invoice dates.

    The watermark is the time of arrival: no line is late, and copies are dropped when they
    arrive within ``lateness`` of each other, which bounds the state Spark keeps. A stream
    has no partial step before its shuffle, so the copies inside every Arrow batch go first,
    without a state: a line with very many copies leaves one row per batch. Start the stream
    within :func:`~surtido.session.state_on_disk`: the state holds 128 bits of every line of that
    time, however wide the lines are.
    """
    kept = keep_sales(raw)
    kept, keys = _with_hashes(kept.mapInArrow(_once_a_batch, kept.schema))
    kept = kept.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, lateness)
    return normalize_lines(kept.dropDuplicatesWithinWatermark(keys).drop(ARRIVED, *HASHES))
