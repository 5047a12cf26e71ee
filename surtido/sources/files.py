"""Invoice files: CSV, workbooks and parquet, checked and typed."""

from __future__ import annotations

import os
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surtido.constants import DATE_FORMATS, REQUIRED_COLUMNS
from surtido.operators.dates import infer_formats
from surtido.functions import nan_to_null, parse_timestamp, with_missing_as_null
from surtido.sources.workbook import read_workbooks


# Headers read at a time.
HEADER_READERS = 16


def _first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a text file, compressed or not; the rest is not read."""
    jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(settings).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(settings).getCodec(path)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
        stream if codec is None else codec.createInputStream(stream), "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def files_by_header(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """The files under some paths by their first line; empty files are left out.

    Spark lists the files, as for any scan, and does not open them for that.
    """
    files = [r["path"] for r in spark.read.format("binaryFile").load(list(paths)).select(
        "path").collect()]
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        lines = pool.map(lambda file: _first_line(spark, file), files)
        groups: dict[str, list[str]] = {}
        for file, line in sorted(zip(files, lines)):
            if line is not None:
                groups.setdefault(line, []).append(file)
    return groups


def _read_csv(spark: SparkSession, paths: list[str], multi_line: bool) -> list[DataFrame]:
    # FAILFAST: a record broken over lines would otherwise turn into nulls and be
    # filtered out without a word. multi_line reads such files, but no longer splits them.
    reader = (
        spark.read.option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        # A scan takes its columns by position, so files of one header share a scan; a file
        # that does not have it after all stops the job.
        .option("enforceSchema", False)
    )
    groups = files_by_header(spark, paths)
    scans = list(groups.values()) if len(groups) > 1 else [paths]
    return [without_missing_tokens(reader.csv(files)) for files in scans]


def _read_xlsx(spark: SparkSession, paths: list[str], multi_line: bool) -> list[DataFrame]:
    return [without_missing_tokens(read_workbooks(spark, paths))]


def _read_parquet(spark: SparkSession, paths: list[str], multi_line: bool) -> list[DataFrame]:
    return [spark.read.parquet(*paths)]


READERS = {".csv": _read_csv, ".xlsx": _read_xlsx, ".parquet": _read_parquet}


def without_missing_tokens(texts: DataFrame) -> DataFrame:
    return texts.select(*[with_missing_as_null(_named(c)).alias(c) for c in texts.columns])


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def load_dataset(spark: SparkSession, path: str | Sequence[str], *, strict: bool = True,
                 multi_line: bool = False, file_format: str | None = None,
                 formats: Sequence[str] | None = DATE_FORMATS) -> DataFrame:
    """Invoice lines of files or folders, with checked columns and types, as one data set.

    The extension chooses the reader; ``file_format`` names it for a folder whose name
    has none. Columns are matched by name, also between CSV files of different column order.
    ``formats`` are the patterns of date texts, tried in their order after ISO; with None they
    are inferred from the shapes of all texts, which takes one more pass over the file.
    """
    by_format: dict[str, list[str]] = {}
    for one in [path] if isinstance(path, str) else path:
        extension = f".{file_format}" if file_format else os.path.splitext(one.rstrip("/"))[1]
        if extension.lower() not in READERS:
            raise ValueError(f"unsupported format '{extension}': use {', '.join(READERS)}")
        by_format.setdefault(extension.lower(), []).append(one)
    if not by_format:
        raise ValueError("no file to load")
    parts: list[DataFrame] = []
    for extension, paths in by_format.items():
        try:
            scans = READERS[extension](spark, paths, multi_line)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                raise FileNotFoundError(", ".join(paths)) from error
            raise
        for raw in scans:
            validate_columns(raw)
        patterns = _formats(scans, formats)
        parts += [typed(raw, strict=strict, formats=patterns) for raw in scans]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _formats(scans: list[DataFrame], formats: Sequence[str] | None) -> Sequence[str]:
    if formats is not None:
        return formats
    texts = [s.select("InvoiceDate") for s in scans if "InvoiceDate" in s.columns and isinstance(
        s.schema["InvoiceDate"].dataType, T.StringType)]
    return infer_formats(reduce(DataFrame.unionByName, texts), "InvoiceDate").formats if texts else ()


def validate_columns(df: DataFrame) -> None:
    """Raise with the list of required columns that are missing (case-sensitive)."""
    missing = [c for c in REQUIRED_COLUMNS if c not in set(df.columns)]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")


def _as_units(c: Column, strict: bool) -> Column:
    number = c.cast("double") if strict else c.try_cast("double")
    number = nan_to_null(number)
    whole = F.when(number == F.rint(number), number.cast("int") if strict else number.try_cast("int"))
    if not strict:
        return whole
    broken = F.raise_error(F.concat(F.lit("quantity is not whole: "), number.cast("string")))
    return F.when(number != F.rint(number), broken.cast("int")).otherwise(whole)


def _as_number(c: Column, strict: bool) -> Column:
    return nan_to_null(c.cast("double") if strict else c.try_cast("double"))


def _as_moment(c: Column, data_type: T.DataType, strict: bool, formats: Sequence[str]) -> Column:
    return parse_timestamp(c, formats, strict) if isinstance(data_type, T.StringType) else c


def typed(df: DataFrame, strict: bool = True,
          formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Invoice columns with their types; all other columns stay as they are.

    Strict mode raises on a value that does not fit, lenient mode makes it null.
    """
    types = {f.name: f.dataType for f in df.schema}
    out: list[Column] = []
    for name in df.columns:
        c = _named(name)
        if name in ("InvoiceNo", "StockCode", "Description"):
            c = c.cast("string")
        elif name == "Quantity":
            c = c if isinstance(types[name], T.IntegerType) else _as_units(c, strict)
        elif name in ("UnitPrice", "CustomerID"):
            c = _as_number(c, strict)
        elif name == "InvoiceDate":
            c = _as_moment(c, types[name], strict, formats)
        out.append(c.alias(name))
    return df.select(*out)


def split_unparseable(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lenient load: (lines that fit the types, raw lines that do not)."""
    checked = [c for c in ("Quantity", "UnitPrice", "InvoiceDate", "CustomerID")
               if c in raw.columns]
    tagged = raw.select(F.struct(*[_named(c) for c in raw.columns]).alias("raw"), "*")
    lenient = typed(tagged, strict=False)
    broken = F.lit(False)
    for name in checked:
        given = F.col(f"raw.{name}")
        if name != "InvoiceDate":
            given = given.cast("string")
        broken = broken | (given.isNotNull() & (given.cast("string") != "NaN")
                           & F.col(name).isNull())
    good = lenient.filter(~broken).drop("raw")
    bad = lenient.filter(broken).select("raw.*")
    return good, bad
