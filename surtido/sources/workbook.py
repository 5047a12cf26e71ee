"""Workbook scan: the first sheet of every XLSX file under a path.

Spark hands out the files (``binaryFile``); a task parses its own workbooks and streams
their rows out in pieces, so no workbook is held as a table and none reaches the driver.
``spark.sql.files.maxPartitionBytes`` bounds how many bytes of workbooks one task gets.
"""

from __future__ import annotations

import datetime as dt
import io
import itertools
import posixpath
import re
import zipfile
from collections.abc import Callable, Iterable, Iterator
from typing import IO
from xml.etree import ElementTree
from xml.parsers import expat
from xml.sax.saxutils import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surtido.session import send_to_workers

send_to_workers(__name__)

ROWS_PER_PIECE = 10_000
PIECE_BYTES = 1 << 18
HEAD_BYTES = 1 << 14
# (type, style, value, inline text) of a cell to its text.
CellText = Callable[[str, str, str | None, str], str | None]

# Fixed values of the XLSX format: name spaces, numbers of the built-in date formats.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
PACKAGE_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"
ROW, CELL, VALUE, TEXT = (MAIN[1:] + tag for tag in ("row", "c", "v", "t"))
DATE_FORMAT_IDS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def _column_index(reference: str) -> int:
    index = 0
    for letter in reference:
        if not letter.isalpha():
            break
        index = index * 26 + ord(letter.upper()) - ord("A") + 1
    return index - 1


def _shared_texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    texts = []
    with book.open("xl/sharedStrings.xml") as part:
        for _, node in ElementTree.iterparse(part):
            if node.tag == MAIN + "si":
                texts.append("".join(t.text or "" for t in node.iter(MAIN + "t")))
                node.clear()
    return texts


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Positions of the cell styles that show a number as a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    date_ids = set(DATE_FORMAT_IDS)
    for fmt in root.iter(MAIN + "numFmt"):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", fmt.get("formatCode", "")).lower()
        if re.search(r"[ymdhs]", code) and "general" not in code:
            date_ids.add(int(fmt.get("numFmtId")))
    styles = root.find(MAIN + "cellXfs")
    formats = [] if styles is None else [int(x.get("numFmtId", "0")) for x in styles]
    return {i for i, fmt in enumerate(formats) if fmt in date_ids}


def _first_sheet(book: zipfile.ZipFile) -> tuple[str, dt.datetime]:
    """Part name of the first sheet, and the day that serial number 0 stands for."""
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    wanted = root.find(f"{MAIN}sheets/{MAIN}sheet").get(REL_ID)
    rels = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in rels.iter(PACKAGE_REL + "Relationship")
                  if r.get("Id") == wanted)
    properties = root.find(MAIN + "workbookPr")
    late = properties is not None and properties.get("date1904") in ("1", "true")
    start = dt.datetime(1904, 1, 1) if late else dt.datetime(1899, 12, 30)
    name = target.lstrip("/") if target.startswith("/") else posixpath.join("xl", target)
    return posixpath.normpath(name), start


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet as texts; dates come as ``yyyy-MM-dd HH:mm:ss``."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        texts, date_styles = _shared_texts(book), _date_styles(book)
        sheet, start = _first_sheet(book)

        days: dict[str, str] = {}  # dates repeat

        def text_of(kind: str, style: str, value: str | None, inline: str) -> str | None:
            if kind == "inlineStr":
                return inline
            if value is None or kind == "e":
                return None
            if kind == "s":
                return texts[int(value)]
            if kind == "n" and date_styles and int(style) in date_styles:
                if value not in days:
                    moment = start + dt.timedelta(seconds=round(float(value) * 86400))
                    days[value] = moment.strftime("%Y-%m-%d %H:%M:%S")
                return days[value]
            return value

        with book.open(sheet) as part:
            yield from _sheet_rows(part, text_of)


# Rows as spreadsheets write them. Others (comments, rich texts, blanks between the tags,
# attributes in another order) go to the XML parser, as does everything after them.
_HEAD = re.compile(
    r"\ufeff?(?:<\?xml version=\"1\.0\"(?: encoding=\"[Uu][Tt][Ff]-8\")?(?: standalone=\"\w+\")?"
    r" ?\?>\s*)?<worksheet (?:[^<>!]* )?xmlns=\"" + MAIN[1:-1] + r"\"[^<>!]*>(?:<[^!>]*>)*?<sheetData>")
_ROW = re.compile(r"<row(?: [^<>]*[^<>/])?>")
_CELL = re.compile(
    r'(<c(?: r="([A-Z]+)\d+")?(?: s="(\d+)")?(?: t="(\w+)")?'
    r'(?:/>|>(?:<f>[^<]*</f>)?(?:(<v>)([^<]*)</v>|<is><t(?: xml:space="preserve")?>([^<]*)</t></is>)?</c>))')
_ENTITY = re.compile(r"&(?!(?:amp|lt|gt);)")
ROW_END = "</row>"


def _plain_row(text: str, text_of: CellText) -> list[str | None] | None:
    """The cells of a row without its end tag; None if it is not of the usual form."""
    begin = _ROW.match(text)
    if not begin or "\r" in text or ("&" in text and _ENTITY.search(text)):
        return None
    escaped, size, row = "&" in text, begin.end(), []
    for whole, letters, style, kind, given, value, inline in _CELL.findall(text, size):
        size += len(whole)
        if escaped:
            value, inline = unescape(value), unescape(inline)
        found = text_of(kind or "n", style or "0", value if given else None, inline)
        if letters:
            at = _column_index(letters)
            row.extend([None] * (at + 1 - len(row)))
            row[at] = found
        else:
            row.append(found)
    return row if size == len(text) else None


def _sheet_rows(part: IO[bytes], text_of: CellText) -> Iterator[list[str | None]]:
    """Rows of a sheet's XML, which is read in pieces."""
    begin = part.read(PIECE_BYTES)
    head = _HEAD.match(begin[:HEAD_BYTES].decode("utf-8", "replace"))
    if not head:
        yield from _parsed_rows(itertools.chain([begin], _pieces(part)), text_of)
        return
    head_bytes = head.group().encode()
    rest = begin[len(head_bytes):]
    for piece in itertools.chain([b""], _pieces(part)):
        rest += piece
        *lines, rest = rest.split(ROW_END.encode())
        for i, line in enumerate(lines):
            row = _plain_row(line.decode(), text_of)
            if row is None:
                left = ROW_END.encode().join([*lines[i:], rest])
                yield from _parsed_rows(
                    itertools.chain([head_bytes, left], _pieces(part)), text_of)
                return
            yield row
    # What follows the last row has none, or a row that has no end tag.
    yield from _parsed_rows([head_bytes, rest], text_of)


def _pieces(part: IO[bytes]) -> Iterator[bytes]:
    return iter(lambda: part.read(PIECE_BYTES), b"")


def _parsed_rows(pieces: Iterable[bytes], text_of: CellText) -> Iterator[list[str | None]]:
    """Rows of any XML of a sheet: the parser's events fill one cell at a time."""
    rows: list[list[str | None]] = []
    row: list[str | None] = []
    cell: dict[str, str] | None = None
    value: str | None = None
    words: list[str] = []
    depth = 0
    parser = expat.ParserCreate(namespace_separator="}")
    parser.buffer_text = True

    def begin(tag: str, attributes: dict[str, str]) -> None:
        nonlocal row, cell, value, depth
        if tag == CELL:
            cell, value, depth = attributes, None, 0
            words.clear()
        elif tag == ROW:
            row, cell = [], None
        elif cell is not None:
            depth += 1
            if tag == TEXT or (tag == VALUE and depth == 1 and value is None):
                parser.CharacterDataHandler = words.append
                if tag == VALUE:
                    words.clear()

    def finish(tag: str) -> None:
        nonlocal cell, value, depth
        if tag == CELL:
            place = cell.get("r")
            found = text_of(cell.get("t", "n"), cell.get("s", "0"), value, "".join(words))
            if place:
                at = _column_index(place)
                row.extend([None] * (at + 1 - len(row)))
                row[at] = found
            else:
                row.append(found)
            cell = None
        elif tag == ROW:
            rows.append(row)
        elif cell is not None:
            depth -= 1
            if tag == TEXT or tag == VALUE:
                parser.CharacterDataHandler = None
                if tag == VALUE and depth == 0 and value is None:
                    value = "".join(words)

    parser.StartElementHandler, parser.EndElementHandler = begin, finish
    for piece in pieces:
        parser.Parse(piece)
        yield from rows
        rows.clear()
    parser.Parse(b"", True)
    yield from rows


def _header(row: list[str | None]) -> list[str]:
    return [name if name else f"Unnamed: {i}" for i, name in enumerate(row)]


def _headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            names = _header(next(sheet_rows(content), []))
            yield pd.DataFrame({"path": path, "position": range(len(names)), "name": names})


def _records(columns: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The reader of a task: rows with a cell, as texts under the given names."""
    def piece(names: list[str], rows: list[list[str | None]]) -> pa.RecordBatch:
        width = len(names)
        cells: dict[str, list[str | None]] = {}
        for at, found in enumerate(zip(*[r[:width] + [None] * (width - len(r)) for r in rows])):
            before = cells.get(names[at])  # of columns with one name the last value counts
            cells[names[at]] = list(found) if before is None else [
                b if f is None else f for b, f in zip(before, found)]
        nothing = [None] * len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(cells.get(name, nothing), pa.string()) for name in columns] or [
                pa.array(nothing, pa.string())],
            [f"c{i}" for i in range(len(columns) or 1)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = sheet_rows(content.as_py())
                names = _header(next(rows, []))
                width, held = len(names), []
                for row in rows:
                    if any(v is not None for v in row[:width]):
                        held.append(row)
                        if len(held) == ROWS_PER_PIECE:
                            yield piece(names, held)
                            held = []
                if held:
                    yield piece(names, held)

    return read


def workbook_columns(files: DataFrame) -> list[str]:
    """Distinct column names of the workbooks, in the order of the first one that has them."""
    names = (
        files.mapInPandas(_headers, "path string, position int, name string")
        .groupBy("name").agg(F.min(F.struct("path", "position")).alias("first"))
        .orderBy("first")
    )
    return [row["name"] for row in names.collect()]


def workbook_rows(files: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of all workbooks (``path, content``) as text columns, matched by name."""
    schema = ", ".join(f"c{i} string" for i in range(len(columns) or 1))
    cells = files.mapInArrow(_records(columns), schema)
    return cells.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(columns)])


def read_workbooks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All workbooks under the paths; a first small job gathers their column names."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
    files = files.select("path", "content")
    return workbook_rows(files, workbook_columns(files))
