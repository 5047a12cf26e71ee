"""Line dedup: sorted line hashes, first occurrences streamed, keep bitmaps per document."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surtido.llm.common import SPACES, by_value, pieces, stored

by_value(__name__)

LEAST_CHARS = 10

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FOUND = ("kind int, h1 bigint, h2 bigint, doc_id {0}, mark bigint, line int")
_DROP, _FIRST, _LAST = 0, 1, 2


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and ``mark``, which tells rows of one doc_id with different texts apart."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(
        F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn(
            "mark", F.xxhash64("text"))


def line_keys(rows: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(h1, h2, doc_id, mark, line) of every line whose key is long enough; 128 hash bits."""
    key = F.translate(F.btrim(F.col("text"), F.lit(SPACES)), _UPPER, _UPPER.lower())
    lines = rows.select("doc_id", "mark", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    lines = lines.select("doc_id", "mark", "line", key.alias("key"))
    return lines.where(F.length("key") >= least_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
        "doc_id", "mark", "line")


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Later occurrences within a sorted partition, and what its neighbours need to know.

    A row of another document than the first of its hash is dropped. The first group may
    have begun in an earlier partition, so its rows of the first document are reported;
    so is the first document of the last group. Only the open group's head is remembered.
    """
    head, leading, names = None, True, None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.schema
        h1, h2 = (batch.column(c).to_numpy() for c in ("h1", "h2"))
        ids = batch.column("doc_id")
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new[0] = head is None or (int(h1[0]), int(h2[0])) != head[:2]
        starts = np.flatnonzero(new)
        group = np.searchsorted(starts, np.arange(len(h1)), side="right") - 1
        firsts = pa.concat_arrays([
            ids.take(pa.array(starts)), pa.array([head[2] if head else None], ids.type)])
        first = firsts.take(pa.array(np.where(group < 0, len(starts), group)))
        same = pc.or_(pc.fill_null(pc.equal(ids, first), False),
                      pc.and_(pc.is_null(ids), pc.is_null(first)))
        same = same.to_numpy(zero_copy_only=False)
        kind = np.where(same, -1, _DROP).astype(np.int32)
        if leading:
            group_end = len(h1)
            if head is not None:
                group_end = int(starts[0]) if len(starts) else len(h1)
            elif len(starts) > 1:
                group_end = int(starts[1])
            kind[:group_end][same[:group_end]] = _FIRST
            leading = group_end == len(h1)
        out = np.flatnonzero(kind >= 0)
        if len(out):
            picked = batch.take(pa.array(out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind[out]), *[picked.column(c) for c in (
                    "h1", "h2", "doc_id", "mark", "line")]],
                ["kind", "h1", "h2", "doc_id", "mark", "line"])
        last = firsts[int(group[-1])].as_py() if group[-1] >= 0 else head[2]
        head = (int(h1[-1]), int(h2[-1]), last)
    if head is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([_LAST], pa.int32()), pa.array([head[0]], pa.int64()),
             pa.array([head[1]], pa.int64()), pa.array([head[2]], names.field("doc_id").type),
             pa.array([0], pa.int64()), pa.array([0], pa.int32())],
            ["kind", "h1", "h2", "doc_id", "mark", "line"])


def repeated_lines(keys: DataFrame) -> DataFrame:
    """(doc_id, mark, line) of the lines that a document with a smaller doc_id has as well.

    The rows are range-partitioned and sorted by hash, document and position. The position
    takes part in the ranges, so a line that many documents hold spreads over partitions;
    what its first partition knows reaches the others through one row per partition.
    """
    order = ["h1", "h2", "has_id", "doc_id", "mark", "line"]
    rows = keys.withColumn("has_id", F.col("doc_id").isNull()).select(*order)
    kind = keys.schema["doc_id"].dataType.simpleString()
    found = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _stream, _FOUND.format(kind)))
    heads = found.where(F.col("kind") == _LAST).groupBy("h1", "h2").agg(
        F.min("doc_id").alias("first"))
    carried = found.where(F.col("kind") == _FIRST).join(heads, ["h1", "h2"]).where(
        (F.col("first") < F.col("doc_id")) | (F.col("doc_id").isNull() & F.col("first").isNotNull()))
    columns = ("doc_id", "mark", "line")
    return found.where(F.col("kind") == _DROP).select(*columns).unionByName(
        carried.select(*columns))


def pack(dropped: list[int]) -> bytes:
    """A keep bitmap up to the byte of the last dropped line, a bit per line, compressed."""
    keep = np.ones(max(dropped) // 8 * 8 + 8, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes())


def unpack(bitmap: bytes | None, n_lines: int) -> np.ndarray:
    """Which of the lines stay; lines behind the bitmap do."""
    keep = np.ones(n_lines, bool)
    if bitmap is not None:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), bitorder="little")
        known = min(n_lines, len(bits))
        keep[:known] = bits[:known].astype(bool)
    return keep


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = [pack(d) for d in batch.column("dropped").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("mark"), pa.array(maps, pa.binary())],
            ["doc_id", "mark", "keep"])


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 least_chars: int = LEAST_CHARS) -> DataFrame:
    """``doc_id, mark, keep`` of the documents that lose lines.

    A line's key is the line without white space at both ends, A-Z lower-cased. Keys of at
    least ``least_chars`` code points that several documents hold stay in the one with the
    smallest doc_id only. ``keep`` has one bit per line, compressed; a document that is not
    returned keeps all. ``mark`` is a hash of the text. Rows of one doc_id are one document;
    a null doc_id comes after all others; a null or empty text is one empty line; an empty
    table gives no rows; other columns are left out.
    """
    rows = _marked(docs, id_col, text_col)
    dropped = repeated_lines(line_keys(rows, least_chars)).distinct().groupBy(
        "doc_id", "mark").agg(F.collect_list("line").alias("dropped"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    # A table of its own, so that a later join can split documents of many rows.
    return stored(dropped.mapInArrow(_bitmaps, f"doc_id {kind}, mark bigint, keep binary"))


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            texts, counts, losses = [], [], []
            for text, bitmap in zip(piece.column("text").to_pylist(),
                                    piece.column("keep").to_pylist()):
                lines = text.split("\n")
                keep = unpack(bitmap, len(lines))
                texts.append("\n".join(x for x, k in zip(lines, keep) if k)
                             if bitmap is not None else text)
                counts.append(len(lines))
                losses.append(len(lines) - int(keep.sum()))
            rest = [piece.column(i) for i in range(2, piece.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), pa.array(counts, pa.int64()),
                 pa.array(losses, pa.int64()), *rest],
                ["text", "n_lines", "n_dropped", *piece.schema.names[2:]])


def drop_lines(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``text, n_lines, n_dropped, row``: the kept lines, and the given row as a struct.

    ``n_lines`` counts before dropping. Every row comes back, whatever its columns' names; a
    null text counts as empty, one empty line that stays; repeated rows lose the same lines; a
    very long text is handled by itself; an empty table gives no rows.
    """
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    rows = rows.select(
        F.col("row")[id_col].alias("id"),
        F.coalesce(F.col("row")[text_col].cast("string"), F.lit("")).alias("text"),
        F.col("row").dropFields(text_col).alias("row") if len(docs.columns) > 1 else "row")
    rows = rows.withColumn("mark", F.xxhash64("text"))
    joined = rows.join(
        bitmaps.select(F.col("doc_id").alias("of"), F.col("mark").alias("of_mark"), "keep"),
        F.col("id").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("of_mark")), "left")
    joined = joined.select("text", "keep", "row")
    kind = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(
        _apply, f"text string, n_lines bigint, n_dropped bigint, row {kind}")
