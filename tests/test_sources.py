import datetime as dt
import gzip
import os

import pandas as pd
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from surtido.operators.dates import date_shapes, infer_formats
from surtido.registry.tables import workbook
from surtido.sources import load_dataset, split_unparseable, validate_columns
from surtido.sources.files import files_by_header
from surtido.sources.tables import bounds_query, range_predicates
from surtido.sources.workbook import sheet_rows

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


def write(folder, text, name="lines.csv"):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as file:
        file.write(HEADER + text)
    return path


def test_csv_dialect_types_and_missing_texts(spark, tmp_path):
    path = write(tmp_path, '536365,85123A,"a ""big"", ñ",6,12/1/2010 8:26,2.55,17850,UK\n'
                           "C1,x,NA,-2,2010-12-01T08:26:00,1e3,,N/A\n"
                           "2,y,null,5.0,2010-12-01,0,nan,UK\n")
    rows = load_dataset(spark, path).collect()
    assert rows[0].Description == 'a "big", ñ'
    assert rows[0].InvoiceDate == dt.datetime(2010, 12, 1, 8, 26)
    assert (rows[0].Quantity, rows[0].UnitPrice, rows[0].CustomerID) == (6, 2.55, 17850.0)
    assert rows[1].Description is None and rows[1].CustomerID is None and rows[1].Country is None
    assert rows[1].UnitPrice == 1000.0
    assert rows[2].Quantity == 5 and rows[2].InvoiceDate == dt.datetime(2010, 12, 1)


@pytest.mark.parametrize("line", ["1,a,b,x,2010-12-01,1,1,UK", "1,a,b,1.5,2010-12-01,1,1,UK",
                                  "1,a,b,1,the first,1,1,UK", "1,a,b,1,2010-12-01,one,1,UK"])
def test_strict_load_stops_and_lenient_load_sets_aside(spark, tmp_path, line):
    path = write(tmp_path, line + "\n2,a,b,1,2010-12-01,1,,UK\n")
    with pytest.raises(PySparkException):
        load_dataset(spark, path).collect()
    raw = spark.read.option("header", True).csv(path)
    good, bad = split_unparseable(raw)
    assert [r.InvoiceNo for r in good.collect()] == ["2"]
    assert [r.InvoiceNo for r in bad.collect()] == ["1"]
    assert bad.columns == raw.columns


def test_line_breaks_inside_quotes_need_the_option(spark, tmp_path):
    path = write(tmp_path, '1,a,"two\nlines",1,2010-12-01,1,1,UK\n')
    with pytest.raises((PySparkException, Py4JJavaError), match="FAILED_READ_FILE"):
        load_dataset(spark, path).collect()
    assert load_dataset(spark, path, multi_line=True).first().Description == "two\nlines"


def test_missing_file_format_and_columns(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_dataset(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError, match="unsupported format '.txt'"):
        load_dataset(spark, str(tmp_path / "lines.txt"))
    df = spark.createDataFrame([("1", 1)], "invoiceno string, Quantity int")
    with pytest.raises(ValueError) as error:
        validate_columns(df)
    assert "InvoiceNo" in str(error.value) and "Quantity" not in str(error.value)


def test_extension_case_and_folders(spark, tmp_path):
    path = write(tmp_path, "1,a,b,1,2010-12-01,1,1,UK\n", "LINES.CSV")
    assert load_dataset(spark, path).count() == 1
    assert load_dataset(spark, str(tmp_path), file_format="csv").count() == 1


def test_files_of_one_upload_may_order_their_columns_differently(spark, tmp_path):
    write(tmp_path, "1,a,b,5,2010-12-01,2,1,UK\n", "a.csv")
    write(tmp_path, "2,a,b,6,2010-12-01,2,1,UK\n", "c.csv")
    (tmp_path / "empty.csv").write_text("")
    other = HEADER.replace("Quantity", "x").replace("UnitPrice", "Quantity").replace(
        "x,", "UnitPrice,").replace("CustomerID,", "")
    with gzip.open(tmp_path / "b.csv.gz", "wt", encoding="utf-8") as file:
        file.write(other + "3,a,b,2.0,2010-12-01,7,UK\n")
    rows = load_dataset(spark, str(tmp_path), file_format="csv")
    got = sorted((r.InvoiceNo, r.Quantity, r.UnitPrice, r.CustomerID) for r in rows.collect())
    assert got == [("1", 5, 2.0, 1.0), ("2", 6, 2.0, 1.0), ("3", 7, 2.0, None)]
    assert sorted(map(len, files_by_header(spark, [str(tmp_path)]).values())) == [1, 2]
    (tmp_path / "d.csv").write_text("InvoiceNo,StockCode\n1,a\n")
    with pytest.raises(ValueError, match="missing required columns"):
        load_dataset(spark, str(tmp_path), file_format="csv")


def inferred(spark, *texts):
    return infer_formats(spark.createDataFrame([(t,) for t in texts], "`a.b` string"), "a.b")


def test_date_formats_are_inferred_from_all_texts(spark, tmp_path):
    found = inferred(spark, "3/4/2011", "25/12/2010 8:26", "1/2/2011 08:26", None)
    assert set(found.formats) == {"d/M/yyyy", "d/M/yyyy H:mm"}
    assert (found.ambiguous, found.contradictory, found.unread) == (0, 0, 0)
    found = inferred(spark, "3/4/2011", "12/25/2010")
    assert found.formats == ("M/d/yyyy",) and found.ambiguous == 0
    found = inferred(spark, "3/4/2011", "2010-12-25", "")
    assert found.formats == ("M/d/yyyy",) and found.ambiguous == 1 and found.unread == 0
    found = inferred(spark, "13/4/2011", "4/13/2011", "the first", "the first", "x" * 99)
    assert found.contradictory == 2 and found.unread == 3 and found.examples[0] == "the first"
    found = inferred(spark, "1 December 2010", "Dec 1, 2010 9:05 PM", "2010.12.1", "1.12.10")
    assert set(found.formats) == {"d MMMM yyyy", "MMM d, yyyy h:mm a", "yyyy.M.d", "M.d.yy"}
    assert inferred(spark).formats == () == inferred(spark, None).formats

    texts = ("25. 12. 2010", "24. 12. 2010")
    path = write(tmp_path, "".join(f"1,a,b,{i + 1},{t},1,1,UK\n" for i, t in enumerate(texts)))
    with pytest.raises(PySparkException):
        load_dataset(spark, path).collect()
    days = [r.InvoiceDate for r in load_dataset(spark, path, formats=None).orderBy(
        "Quantity").collect()]
    assert days == [dt.datetime(2010, 12, 25), dt.datetime(2010, 12, 24)]


@pytest.mark.parametrize("pattern, text", [
    ("%d/%m/%Y", "9/9/Y"), ("%d-%b-%Y %H:%M:%S", "9-a-Y 9:9:9"), ("%B %d, %Y", "aa 9, Y"),
    ("%Y%m%d", "D"), ("%Y-%m-%dT%H:%M:%S", "Y-9-9a9:9:9")])
def test_shapes(spark, pattern, text):
    day = dt.datetime(2010, 11, 25, 8, 26, 5).strftime(pattern)
    shapes = date_shapes(spark.createDataFrame([(f" {day} ",)] * 3, "d string"), "d").collect()
    assert [(r.forma, r.filas) for r in shapes] == [(text, 3)]


@pytest.mark.parametrize("text", ["2010/12/01 08:26", "01-Dec-2010 08:26", "12/1/2010 8:26"])
def test_more_date_texts(spark, tmp_path, text):
    path = write(tmp_path, f"1,a,b,1,{text},1,1,UK\n")
    assert load_dataset(spark, path).first().InvoiceDate == dt.datetime(2010, 12, 1, 8, 26)


def test_own_date_formats(spark, tmp_path):
    path = write(tmp_path, "1,a,b,1,01.12.2010,1,1,UK\n")
    rows = load_dataset(spark, path, formats=["dd.MM.yyyy"])
    assert rows.first().InvoiceDate == dt.datetime(2010, 12, 1)


def test_several_files_are_one_data_set(spark, tmp_path):
    a = write(tmp_path, "1,a,b,1,2010-12-01,1,1,UK\n", "a.csv")
    b = write(tmp_path, "2,a,b,1,2010-12-01,1,1,UK\n", "b.csv")
    spark.read.option("header", True).csv(a).write.parquet(str(tmp_path / "c.parquet"))
    assert load_dataset(spark, [a, b]).count() == 2
    with pytest.raises(ValueError, match="no file"):
        load_dataset(spark, [])


def frame(**changes):
    row = dict(InvoiceNo="1", StockCode="a", Description=" b & <c> ", Quantity=2,
               InvoiceDate=pd.Timestamp("2010-12-01 08:26:00"), UnitPrice=2.55, CustomerID=7.0)
    return pd.DataFrame([row | changes])


def test_workbooks_of_a_folder_are_matched_by_column_name(spark, tmp_path):
    first = pd.concat([frame(), frame(InvoiceNo=536365, Description=None)], ignore_index=True)
    (tmp_path / "a.xlsx").write_bytes(workbook(first))
    second = frame(InvoiceNo="3")[["UnitPrice", "InvoiceNo", "StockCode", "Description", "Quantity",
                                   "InvoiceDate"]].assign(Country="UK")
    (tmp_path / "b.xlsx").write_bytes(workbook(second))
    rows = {r.InvoiceNo: r for r in load_dataset(spark, str(tmp_path), file_format="xlsx").collect()}
    assert set(rows) == {"1", "536365", "3"}
    assert rows["1"].InvoiceDate == dt.datetime(2010, 12, 1, 8, 26)
    assert rows["1"].Description == " b & <c> " and rows["536365"].Description is None
    assert rows["3"].Country == "UK" and rows["3"].CustomerID is None
    assert rows["3"].UnitPrice == 2.55 and rows["1"].Country is None


def test_sheet_rows_reads_shared_texts_and_cell_places():
    import io
    import zipfile

    content = workbook(frame())
    parts = {}
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        parts = {n: book.read(n).decode() for n in book.namelist()}
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    parts["xl/sharedStrings.xml"] = (
        f"<sst {main}><si><t>one</t></si><si><r><t>t</t></r><r><t>wo</t></r></si></sst>")
    parts["xl/worksheets/s.xml"] = (
        f'<worksheet {main}><sheetData><row><c r="A1" t="s"><v>0</v></c>'
        '<c r="C1" t="s"><v>1</v></c></row><row><c r="C2"><v>1.5</v></c></row></sheetData></worksheet>')
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as book:
        for name, text in parts.items():
            book.writestr(name, text)
    assert list(sheet_rows(buffer.getvalue())) == [["one", None, "two"], [None, None, "1.5"]]


def matches(predicate, value):
    text = predicate.replace("k IS NULL", str(value is None)).replace("OR", "or").replace("AND", "and")
    if value is None:
        return "True" in text
    return bool(eval(text.replace("k ", f"{value!r} ")))


@pytest.mark.parametrize("cuts", [[], [None], [5], [1, 2, 3], [3, 3, 9], [9, 3, None, 3]])
def test_every_row_of_a_database_is_read_once(cuts):
    predicates = range_predicates("k", cuts)
    assert len(predicates) == len({c for c in cuts if c is not None}) + 1
    for value in [None, *range(-2, 12)]:
        if predicates != ["1 = 1"]:
            assert sum(matches(p, value) for p in predicates) == 1


def test_split_points_are_quantiles_of_the_database():
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT CASE WHEN i % 3 = 0 THEN 7 ELSE i END AS k FROM range(900) r(i)")
    cuts = con.execute(bounds_query("t", "k", 6)).fetchone()
    sizes = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0]
             for p in range_predicates("k", cuts)]
    assert sum(sizes) == 900 and max(sizes) <= 900 // 6 + 300
    assert range_predicates("d", [dt.date(2011, 1, 2), dt.date(2010, 1, 2)])[1] == (
        "d >= '2010-01-02' AND d < '2011-01-02'")
