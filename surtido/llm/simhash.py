"""Near duplicates by SimHash: fingerprints, an inverted index of their bytes, count filter.

Two 64-bit fingerprints that differ in at most d bits differ in at most d of their 8 bytes,
so they share at least 8 - d positional bytes. A posting list of one byte holds a 256th of
all fingerprints and would pair nearly everything, so the index intersects lists up front:
its keys are two of the four 16-bit quarters with their positions. With d = 2 at least two
quarters agree, so a link meets in one of the six keys. Pairs that meet are tallied by shared
positional bytes, those below 8 - d are dropped, and the rest are verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surtido.llm.common import by_value, components, pieces, stored

by_value(__name__)

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
# Fingerprints under one key that are paired with each other; longer lists are linked
# through their neighbours at one bit.
LIST_MOST = 64
# Shingle hashes counted at a time.
HASHES_AT_ONCE = 1 << 16

_QUARTERS = 4
_PAIRS = tuple(combinations(range(_QUARTERS), 2))


def _fingerprint(text: str | None, width: int) -> int:
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-width].tolist()]
    stops = (ends[width - 1:] - 1).tolist()
    n, counts = len(starts), np.zeros(64, np.int64)
    for i in range(0, n, HASHES_AT_ONCE):
        hashes = np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(
            starts[i:i + HASHES_AT_ONCE], stops[i:i + HASHES_AT_ONCE])], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, mark, fp): ``fp`` is the fingerprint as a signed number, zero without words.

    ``mark`` is a hash of the text, which tells rows of one doc_id apart.
    """
    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                values = np.array([_fingerprint(t, width)
                                   for t in piece.column("text").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("mark"),
                     pa.array(values.view(np.int64))], ["doc_id", "mark", "fp"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("mark"),
                       F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(worker, f"doc_id {kind}, mark bigint, fp bigint")


def _quarter(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, 16 * i).bitwiseAND(0xFFFF)


def _shared_bytes(a: Column, b: Column) -> Column:
    both = a.bitwiseXOR(b)
    return sum((F.when(F.shiftrightunsigned(both, 8 * i).bitwiseAND(0xFF) == 0, 1).otherwise(0)
                for i in range(8)), F.lit(0))


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough to join all that are near.

    Every pair within ``max_bits`` bits is connected by the links returned, and every link
    is such a pair. A list of up to ``LIST_MOST`` fingerprints gives its pairs. In a longer
    list, as near copies make, two fingerprints are near exactly if they share a value at
    most one bit away from both; each such value joins at most 33 fingerprints, which are
    all near each other and are hung on the least. Below two bits a fingerprint is linked to
    those that are one bit away from it. So no list is cut and none is squared.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the index guarantees links of at most 2 bits")
    prints = prints.select("fp").distinct()
    keys = F.array(*[F.struct(
        F.lit(n).alias("lists"),
        (_quarter(F.col("fp"), i) * 65536 + _quarter(F.col("fp"), j)).alias("value"))
        for n, (i, j) in enumerate(_PAIRS)])
    index = stored(prints.select(F.explode(keys).alias("k"), "fp").select("k.*", "fp"))
    sizes = index.groupBy("lists", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")

    listed = index.join(sizes.where(F.col("n") <= LIST_MOST).drop("n"), ["lists", "value"])
    members = listed.groupBy("lists", "value").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    pairs = members.select(F.posexplode("fps").alias("at", "a"), "fps").select(
        "a", F.explode(F.expr("slice(fps, at + 2, size(fps))")).alias("b"))
    pairs = pairs.where(_shared_bytes(F.col("a"), F.col("b")) >= 8 - max_bits)

    hot = index.join(sizes.where(F.col("n") > LIST_MOST).drop("n"), ["lists", "value"])
    free = F.when(F.lit(False), F.array().cast("array<int>"))
    for n, (i, j) in enumerate(_PAIRS):
        bits = [b for q in range(_QUARTERS) if q not in (i, j) for b in range(16 * q, 16 * q + 16)]
        free = free.when(F.col("lists") == n, F.array(*map(F.lit, bits)))
    one = F.lit(1).cast("long")
    near = F.concat(F.array("fp"), F.transform(free, lambda b: F.col("fp").bitwiseXOR(
        F.call_function("shiftleft", one, b))))
    met = hot.select("lists", "fp", F.explode(near).alias("near"))
    met = met.groupBy("lists", "near").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    stars = met.where(F.size("fps") > 1).select(
        F.col("fps")[0].alias("a"), F.explode(F.expr("slice(fps, 2, size(fps))")).alias("b"))

    if max_bits < 2:  # a star's links may be of two bits; take those with the value itself
        stars = met.where(F.array_contains("fps", F.col("near"))).select(
            F.col("near").alias("a"), F.explode("fps").alias("b")).where("a < b")

    return pairs.unionByName(stars).where(
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def _by_component(prints: DataFrame, first: Column, max_bits: int) -> DataFrame:
    """(fp, root, first): every distinct fingerprint, its component, and the component's least.

    ``first`` is aggregated per fingerprint before anything is joined, so copies, however
    many, are one row, and a component has a row per distinct fingerprint.
    """
    nodes = prints.groupBy("fp").agg(F.min(first).alias("own"))
    joined = components(links(nodes, max_bits))
    nodes = nodes.join(joined, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "fp").alias("root"), "own")
    least = nodes.groupBy("root").agg(F.min("own").alias("first"))
    return stored(nodes.join(least, "root").select("fp", "root", "first"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    ``fingerprint`` is in hexadecimal; ``component_id`` is the least doc_id that can be
    reached over links, itself included. Equal fingerprints are one node, so copies are
    never paired. A null text counts as empty (fingerprint zero, linked like any other);
    repeated rows come back as often as they are given; a null doc_id joins its component
    but does not name it; an empty table gives no rows; other columns are left out.
    """
    prints = stored(fingerprints(docs, id_col, text_col, width))
    names = _by_component(prints, F.col("doc_id"), max_bits)
    return prints.join(names, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows without near duplicates: of each component, the row with the smallest doc_id.

    A null text counts as empty, very long texts are hashed by themselves, an empty table gives
    no rows and columns may have any names. Rows without a doc_id stay only where no row of their component has one; of rows that
    share the doc_id, that with the least text hash stays, and of repeated rows one.
    """
    prints = stored(fingerprints(docs, id_col, text_col, width))
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")
    kept = stored(_by_component(prints, key, max_bits).select("first").distinct().select(
        F.col("first.doc_id").alias("kept_id"), F.col("first.mark").alias("kept_mark")))
    given = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    given = given.withColumns({"id": F.col("row")[id_col],
                               "mark": F.xxhash64(F.col("row")[text_col])})
    found = given.join(kept, F.col("id").eqNullSafe(F.col("kept_id"))
                       & (F.col("mark") == F.col("kept_mark")))
    return found.dropDuplicates(["id", "mark"]).select("row.*")
