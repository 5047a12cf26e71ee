"""Helpers of the operators: shared scratch tables, batches of bounded bytes, components."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that separates words: space, and 09 to 0D.
SPACES = " \t\n\x0b\x0c\r"
# Bytes of text a Python worker handles at a time; a longer text is handled alone.
PIECE_BYTES = 4 << 20

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def by_value(module: str) -> None:
    """Send the module's functions to Python workers as code, so they need no copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share.

    It lies under ``spark.checkpoint.dir``. A session on one machine without that setting
    (tests) uses its warehouse folder; a cluster without it is an error, as the folder of one
    machine is lost with it and unseen by the others.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{root}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read again: cuts the lineage.

    The folder stays until :func:`discard` is called, or the cluster's own clean-up.
    """
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    rows = df.sparkSession.read.schema(df.schema).parquet(folder)
    rows.scratch_folder = folder
    return rows


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries run here delete their shuffle files when they end.

    Otherwise Spark deletes them after some later garbage collection of the driver, which may not
    come before the job is done.
    """
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


def discard(table: DataFrame) -> None:
    """Delete a table of :func:`stored` that nothing will read any more."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.scratch_folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, for expressions inside lambdas."""
    return F.transform(F.array(value), body)[0]


def pieces(batch: pa.RecordBatch, column: str,
           limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold at most ``limit`` bytes, or one row each."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def components(links: DataFrame) -> DataFrame:
    """(node, component) of undirected links (a, b): the least node that can be reached.

    Large-star and small-star rounds (Kiveris et al., 2014) hang every node on the least
    node of its neighbourhood until nothing changes. A round aggregates before it joins,
    and is written to the shared folder; nothing is collected. Nodes without links are
    not returned.
    """
    links = stored(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        before = links
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        links = stored(
            small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        discard(before)
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20)"))).first()
        if now == state:
            break
        state = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
