"""Reload the tables whenever invoice files arrive in a landing folder."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from surtido.plans.reload import reload
from surtido.sources.files import READERS

ARRIVALS = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


def arrivals(spark: SparkSession, landing: str) -> DataFrame:
    """Stream of files arriving in a folder (or glob): name and time, their content is not read."""
    files = spark.readStream.format("binaryFile").schema(ARRIVALS).load(landing)
    extension = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    return files.select("path", "modificationTime").filter(extension.isin(list(READERS)))


def files_in_order(batch: DataFrame) -> list[str]:
    """The names of a batch's files, oldest first. Spark's file source lists them as well."""
    return [row["path"] for row in batch.orderBy("modificationTime", "path").collect()]


def watch_landing(spark: SparkSession, landing: str, warehouse: str, checkpoint: str,
                  job: Callable[..., None] = reload, each_file: bool = False,
                  **options) -> StreamingQuery:
    """Run ``job`` for the files that have arrived, then stop.

    All files of a batch are one data set, as the parts of an export are, and replace the
    tables together. With ``each_file`` the job runs once per file, oldest first, as for
    single uploads; a file that cannot be read stops the batch either way. The stream
    carries file names; the job reads the files as ordinary distributed scans. A batch
    repeated after a failure reloads the same files, with the same result.
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        paths = files_in_order(batch)
        for part in ([p] for p in paths) if each_file else [paths] if paths else []:
            job(batch.sparkSession, part, warehouse, **options)

    return (
        arrivals(spark, landing).writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", os.path.join(checkpoint, "landing"))
        .trigger(availableNow=True)
        .start()
    )
