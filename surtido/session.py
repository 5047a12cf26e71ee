"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# Settings the operators rely on. AQE re-plans joins from measured sizes, so a side
# is broadcast only when its real size is below the threshold, and splits skewed
# shuffle partitions otherwise.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def send_to_workers(module_name: str) -> None:
    """Send the functions of a module to Python workers as code, not by name.

    The workers then need no copy of this package on their path.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("surtido")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    A session on one machine without that setting uses a folder in its warehouse; a
    cluster without a shared folder is an error, because a machine-local folder does not
    survive the loss of an executor.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return named or current.get()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    context.setCheckpointDir(named)
    return named


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
STATE = "spark.sql.streaming.stateStore"
STATE_ON_DISK = {
    f"{STATE}.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # All stores of an executor share one bounded cache and write buffer.
    f"{STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{STATE}.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting rows costs one more look-up for every row.
    f"{STATE}.rocksdb.trackTotalNumberOfRows": "false",
    # Each store would set some 5 MB of disk aside, however little it holds.
    f"{STATE}.rocksdb.allowFAllocate": "false",
    f"{STATE}.rocksdb.compression": "zstd",
    f"{STATE}.compression.codec": "zstd",
    # A batch deletes its shuffle files when it ends.
    CLEAN_UP: "true",
}


def state_on_disk(spark: SparkSession):
    """Streams started here keep their state in RocksDB, not as objects in the executors' memory."""
    return _set(spark, STATE_ON_DISK)


def shuffles_freed(spark: SparkSession):
    """Queries run here delete their shuffle files when they end, not after some later collection."""
    return _set(spark, {CLEAN_UP: "true"})


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def fresh_folder(spark: SparkSession) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that this session made, on whatever file system it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def list_folder(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none where there is no such folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(path))


def read_text(spark: SparkSession, file: str) -> str:
    """The content of a small file."""
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new_text(spark: SparkSession, file: str, text: str) -> None:
    """Write a small file that must not exist yet; others see all of it or nothing.

    The text is written aside and renamed, which the file system refuses where the name is taken.
    """
    jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(file)
    aside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    system = target.getFileSystem(settings)
    try:
        stream = system.create(aside)
        stream.write(bytearray(text.encode()))
        stream.close()
        rename_new(spark, aside, target)
    finally:
        system.delete(aside, False)


def rename_new(spark: SparkSession, source, target) -> None:
    """Rename a file; fails if the target exists."""
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(
        getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(source), context.makeQualified(target), options)
