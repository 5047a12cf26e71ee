"""What the jobs shuffle, read and keep: each input once, narrow rows, little state."""

import os
import re
import time

import pytest
from pyspark.sql import functions as F

from surtido.operators.cleaning import clean_lines, clean_stream
from surtido.operators.dates import infer_formats
from surtido.registry import tables
from surtido.session import state_on_disk
from surtido.sources import workbook
from surtido.sources.invoices import SCHEMAS, lines_of



def lines(spark, rows=20):
    return spark.range(0, rows, 1, 2).select(
        F.col("id").cast("string").alias("InvoiceNo"), F.lit("a").alias("StockCode"),
        F.lit("b").alias("Description"), F.lit(2).alias("Quantity"),
        F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(cast(id as int))").alias("InvoiceDate"),
        F.lit(1.5).alias("UnitPrice"), F.lit(3.0).alias("CustomerID"),
        F.lit("NATION_3").alias("Country"))


def counted(spark, frame, column):
    """The frame, and an accumulator of how often a value of the column was computed."""
    seen = spark.sparkContext.accumulator(0)

    def look(value):
        seen.add(1)
        return value

    kind = frame.schema[column].dataType
    return frame.withColumn(column, F.udf(look, kind).asNondeterministic()(column)), seen


def test_texts_of_parts_are_not_shuffled_with_the_items(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = lines_of({n: spark.createDataFrame([], s) for n, s in SCHEMAS.items()
                         if n != "nation"} | {
            "nation": F.broadcast(spark.createDataFrame([], SCHEMAS["nation"]))})
        plan = made._sc._jvm.PythonSQLUtils.explainString(
            made._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    inputs = re.findall(r"\) Exchange\nInput[^\[]*\[\d+\]: \[(.*)\]", plan)
    assert inputs
    assert not [i for i in inputs if "l_quantity" in i and re.search("p_name|StockCode", i)]


def test_flags_without_values_leave_the_line_as_it_is(spark):
    item = [(1, 1, 2.0, 5.0, None, None, flag, None) for flag in ("R", "A", "N", None)]
    made = lines_of({
        "lineitem": spark.createDataFrame(item, SCHEMAS["lineitem"]),
        "orders": spark.createDataFrame([(1, 10)], SCHEMAS["orders"]),
        "part": spark.createDataFrame([(1, "p", "B", "t", 1)], SCHEMAS["part"]),
        "customer": spark.createDataFrame([(10, 3)], SCHEMAS["customer"]),
        "nation": spark.createDataFrame([(3, "n")], SCHEMAS["nation"])}).collect()
    assert [tuple(r) for r in made] == [("1", "b-t ", None, 2, None, 2.5, None, "n")] * 4


@pytest.mark.parametrize("query", ["_lenient", "_load_checks"])
def test_lines_are_made_once(spark, monkeypatch, query):
    made, seen = counted(spark, lines(spark), "Quantity")
    monkeypatch.setattr(tables, "raw", lambda s, d: made)
    getattr(tables, query)(spark, None).collect()
    assert seen.value == 20


def test_arriving_lines_are_made_once(spark, monkeypatch, tmp_path):
    made, seen = counted(spark, lines(spark), "Quantity")
    monkeypatch.setattr(tables, "raw", lambda s, d: made)
    assert len(list(tables._arrivals(spark, None, str(tmp_path)))) == 3
    assert seen.value == 20


def test_date_texts_are_read_once(spark):
    texts = spark.createDataFrame([("13/1/2020",), ("no date",), ("1/2/2020",)], "d string")
    made, seen = counted(spark, texts, "d")
    found = infer_formats(made.coalesce(1), "d")
    assert (found.formats, found.unread, found.examples) == (("d/M/yyyy",), 1, ("no date",))
    assert seen.value == 3


def test_usual_rows_of_a_sheet_need_no_xml_parser(monkeypatch):
    frame = tables.pd.DataFrame({"a": [" x & <y> ", None, "x"], "b": [1.5, 0.0, -0.0]})
    content = tables.workbook(frame)
    whole = workbook._parsed_rows

    def rest(pieces, text_of):
        pieces = list(pieces)
        assert b"<row" not in b"".join(pieces)
        return whole(pieces, text_of)

    monkeypatch.setattr(workbook, "_parsed_rows", rest)
    assert list(workbook.sheet_rows(content)) == [
        ["a", "b"], [" x & <y> ", "1.5"], [None, "0.0"], ["x", "-0.0"]]


def test_clean_stream_keeps_one_state(spark, tmp_path):
    lines(spark).union(lines(spark)).write.parquet(f"{tmp_path}/in")
    arriving = spark.readStream.schema(lines(spark).schema).parquet(f"{tmp_path}/in")
    with state_on_disk(spark):
        stream = clean_stream(arriving).writeStream.format("parquet").option(
            "path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(
            availableNow=True).start()
        stream.awaitTermination()
    progress = stream.recentProgress[0]["stateOperators"]
    assert len(progress) == 1 and any("rocksdb" in m for m in progress[0]["customMetrics"])
    assert spark.read.parquet(f"{tmp_path}/out").count() == 20


def cleaned(spark, rows, folder, parts=2):
    """The rows as a stream cleans them, with copies in several tasks."""
    rows.repartition(parts).write.parquet(f"{folder}/in")
    arriving = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
    with state_on_disk(spark):
        clean_stream(arriving).writeStream.format("parquet").option(
            "path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(
            availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def bytes_in(folder):
    return sum(os.path.getsize(f"{d}/{name}") for d, _, names in os.walk(folder) for name in names)


def test_state_of_clean_stream_does_not_hold_the_lines(spark, tmp_path):
    text = F.concat(*[F.sha2(F.concat(F.lit(f"{i}-"), "InvoiceNo"), 512) for i in range(20)])
    wide = lines(spark, 400).withColumn("Description", text)
    assert cleaned(spark, wide.union(wide), str(tmp_path)).count() == 400
    assert bytes_in(f"{tmp_path}/state/state") < 200_000  # the texts have a million


def test_clean_stream_tells_lines_of_equal_hashes_apart(spark, tmp_path):
    given = [(0.0, [1, 2], [3], (None, 1), "a", None), (-0.0, [1, 2], [3], (None, 1), "a", None),
             (0.0, [1], [2, 3], (None, 1), "a", None), (0.0, [1, 2], [3], (1, None), "a", None),
             (0.0, [1, 2], [3], None, "a", None), (0.0, [1, 2], [3], (None, 1), None, "a"),
             (None, [1, 2], [3], (None, 1), "a", None), (0.0, [1, 2], [3], (None, 1), "a", "")]
    odd = spark.createDataFrame(
        given, "v double, x array<int>, y array<int>, z struct<a: int, b: int>, s string, t string")
    rows = lines(spark, 1).join(odd)
    got = cleaned(spark, rows.union(rows).union(rows), str(tmp_path), 3)
    shown = [str(r) for r in got.select(odd.columns).collect()]
    assert sorted(shown) == sorted(str(r) for r in odd.collect())


def shuffles_on_disk(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return set(re.findall(r"shuffle_(\d+)_\d+_\d+\.data", blocks.getAllFiles().mkString(" ")))


def test_clean_stream_leaves_only_its_lines(spark, monkeypatch, tmp_path):
    made = lines(spark, 300)
    monkeypatch.setattr(tables, "raw", lambda s, d: made.union(made).repartition(3, "InvoiceNo"))
    monkeypatch.setattr(tables, "fresh_folder", lambda s: str(tmp_path))
    before = shuffles_on_disk(spark)
    got = tables._clean_stream(spark, None)
    deadline = time.time() + 20
    # What may be left is the small shuffle of the dates at which the lines are cut.
    while len(shuffles_on_disk(spark) - before) > 1 and time.time() < deadline:
        time.sleep(0.2)
    assert len(shuffles_on_disk(spark) - before) <= 1
    assert [n for n in os.listdir(tmp_path) if bytes_in(f"{tmp_path}/{n}")] == ["lineas"]
    assert sorted(map(str, got.collect())) == sorted(map(str, clean_lines(made).collect()))


def test_a_batch_of_clean_stream_is_bounded(spark, monkeypatch, tmp_path):
    made, removed = lines(spark, 300), []
    monkeypatch.setattr(tables, "raw", lambda s, d: made)
    monkeypatch.setattr(tables, "fresh_folder", lambda s: str(tmp_path))
    monkeypatch.setattr(tables, "BYTES_PER_BATCH", 1, raising=False)
    monkeypatch.setattr(tables, "remove_folder", lambda s, folder: removed.append(folder))
    assert tables._clean_stream(spark, None).count() == 300
    # A batch for each file, and one for the watermark after each of the three parts.
    assert len([n for n in os.listdir(f"{tmp_path}/estado/commits") if n.isdigit()]) > 6
    assert len(removed) == 5
