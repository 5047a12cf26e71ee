"""Benchmark decontamination: rare n-gram seeds join texts to items, then local alignment.

Every copy that the alignment accepts keeps K of the item's G n-grams at least, which follows
from the item's length and the least score: n words in a row between edits. So it keeps one of
any G - K + 1 of them, and these seeds may be chosen freely: the n-grams that the fewest texts
hold. Texts join the items with which they share a seed; a text that holds K n-grams of such an
item is aligned with it around them (Smith-Waterman over words). No copy that would be accepted
is left out, wherever its edits lie. Short items take pairs of words, as their copies need no
three words in a row.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surtido.llm.common import by_value, discard, pieces, stored

by_value(__name__)

GRAM_WORDS = 3
# Least score of a copy, as a share of the item's words.
LEAST_SCORE = 0.6
MATCH, MISMATCH, GAP = 1.0, -1.0, -1.0
# Items that are searched for at a time; more are searched in several passes.
ITEMS_AT_ONCE = 20_000

_WORD = re.compile(r"\w+")
_BITS = 21
_MATCHES = "array<struct<item_id:string,score:double,start_word:int,stop_word:int>>"


@dataclass(frozen=True)
class _Items:
    """A block of items as word numbers, from 1."""

    ids: tuple
    words: dict[str, int]
    texts: tuple[np.ndarray, ...]


@dataclass(frozen=True)
class _Seeds:
    """The n-grams of a block of items, and which items hold each of them, and where."""

    sizes: tuple[int, ...]
    grams: np.ndarray
    first: np.ndarray
    items: np.ndarray
    offsets: np.ndarray
    least_hits: np.ndarray


def _codes(numbers: np.ndarray, size: int) -> np.ndarray:
    """The n-grams as numbers, which differ between sizes; those with an unknown word (0) as 0.

    Beyond two million words of a block two of them may share a number here. That makes seeds
    meet which differ; the alignment compares the words themselves.
    """
    numbers = np.where(numbers > 0, (numbers - 1) % ((1 << _BITS) - 1) + 1, 0)
    n = len(numbers) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    code, known = np.zeros(n, np.int64), np.ones(n, bool)
    for k in range(size):
        part = numbers[k:k + n]
        code = code << _BITS | part
        known &= part > 0
    return np.where(known, code, 0)


def _read_items(rows: list) -> _Items:
    words: dict[str, int] = {}
    ids, texts = [], []
    for row in rows:
        found = _WORD.findall((row["text"] or "").lower())
        if found:
            ids.append(row["item_id"])
            texts.append(np.array([words.setdefault(w, len(words) + 1) for w in found]))
    return _Items(tuple(ids), words, tuple(texts))


def _numbers(text: str | None, words: dict[str, int]) -> np.ndarray:
    found = _WORD.findall((text or "").lower())
    get = words.get
    return np.fromiter((get(w, 0) for w in found), np.int64, len(found))


def _places(codes: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in the text, indexes of the grams) of the grams that the text holds."""
    at = np.flatnonzero(codes)
    if not len(at) or not len(grams):
        return at[:0], at[:0]
    found = np.minimum(np.searchsorted(grams, codes[at]), len(grams) - 1)
    hit = grams[found] == codes[at]
    return at[hit], found[hit]


def _least_points(length: int, least: float) -> int:
    """The least score of a copy of an item of so many words."""
    return max(1, math.ceil(least * length))


def kept_grams(length: int, least: float) -> tuple[int, int]:
    """(n, how many of an item's n-grams every copy keeps at least), for the largest such n.

    A score of p from m matches leaves m - p edits at most, so m - p + 1 runs of matches; a
    run of r words keeps r - n + 1 n-grams. That is linear in m, between p and the length.
    """
    points = _least_points(length, least)
    for n in range(GRAM_WORDS, 1, -1):
        hits = min(m - (n - 1) * (m - points + 1) for m in (points, length))
        if hits > 0:
            return n, hits
    return 1, points


def align(item: np.ndarray, text: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment of an item with a text: score, first and last word in the text.

    One row of the matrix at a time; gaps in the text direction are a running maximum.
    """
    n = len(text)
    slant = GAP * np.arange(n + 1)
    above, start = np.zeros(n + 1), np.arange(n + 1)
    best = (0.0, 0, 0)
    for word in item:
        score = np.zeros(n + 1)
        diagonal = above[:-1] + np.where(text == word, MATCH, MISMATCH)
        up = above[1:] + GAP
        score[1:] = np.maximum(0.0, np.maximum(diagonal, up))
        begin = np.arange(n + 1)
        begin[1:] = np.where(score[1:] <= 0, begin[1:],
                             np.where(diagonal >= up, start[:-1], start[1:]))
        lifted = score - slant
        reach = np.maximum.accumulate(lifted)
        fresh = np.ones(n + 1, bool)
        fresh[1:] = lifted[1:] >= reach[:-1]
        origin = np.maximum.accumulate(np.where(fresh, np.arange(n + 1), 0))
        above, start = np.maximum(score, reach + slant), begin[origin]
        top = int(np.argmax(above))
        if above[top] > best[0]:
            best = (float(above[top]), int(start[top]), top)
    return best


def _windows(starts: np.ndarray, length: int, pad: int,
             n: int) -> Iterator[tuple[int, int, int, int]]:
    """Stretches of the text around the seeds, where the whole item may lie.

    ``starts`` are sorted; the seeds that a copy in the stretch may keep come with it.
    """
    def stretch(i: int, j: int) -> tuple[int, int, int, int]:
        near = np.searchsorted(starts, (starts[i] - 2 * pad, starts[j] + 2 * pad + 1))
        return low, high, *near.tolist()

    low = high = None
    first = 0
    for k, s in enumerate(starts.tolist()):
        a, b = max(0, s - pad), min(n, s + length + pad)
        if high is not None and a <= high:
            high = max(high, b)
            continue
        if high is not None:
            yield stretch(first, k - 1)
        low, high, first = a, b, k
    if high is not None:
        yield stretch(first, len(starts) - 1)


def _common(item: np.ndarray, text: np.ndarray) -> int:
    """How many words of the item the text has, each as often as it has it: bounds the matches."""
    words, wanted = np.unique(item, return_counts=True)
    at = np.minimum(np.searchsorted(words, text), len(words) - 1)
    have = np.bincount(at[words[at] == text], minlength=len(words))
    return int(np.minimum(wanted, have).sum())


def _hits(numbers: np.ndarray, seeds: _Seeds) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(item, starts, offsets) of the items of which a text holds enough n-grams.

    A start is where the item would begin in the text; starts are sorted.
    """
    found = [_places(_codes(numbers, n), seeds.grams) for n in seeds.sizes]
    at, gram = (np.concatenate([f[k] for f in found]) for k in range(2))
    count = seeds.first[gram + 1] - seeds.first[gram]
    holder = np.repeat(seeds.first[gram] - (np.cumsum(count) - count), count) + np.arange(
        count.sum())
    item, offset = seeds.items[holder], seeds.offsets[holder]
    start = np.repeat(at, count) - offset
    order = np.lexsort((start, item))
    item, start, offset = item[order], start[order], offset[order]
    names, first = np.unique(item, return_index=True)
    stops = np.append(first[1:], len(item))
    enough = stops - first >= seeds.least_hits[names]
    for i, a, b in zip(names[enough].tolist(), first[enough].tolist(), stops[enough].tolist()):
        yield i, start[a:b], offset[a:b]


def _copies(item: np.ndarray, text: np.ndarray, points: int) -> Iterator[tuple[float, int, int]]:
    """(score, start, stop) of the copies in a text, from left to right.

    The best one of a chunk is taken first, then those beside it. A copy is shorter than two
    items, so one that begins two items before a chunk's end is whole; later ones are left to
    the next chunk.
    """
    low, chunk = 0, max(64, 8 * len(item))
    while low < len(text):
        high = min(len(text), low + chunk)
        stop = high if high == len(text) else high - 2 * len(item)
        parts, found = [(low, high)], []
        while parts:
            left, right = parts.pop()
            # Every match takes a word that both hold, so this bounds the score.
            if _common(item, text[left:right]) * MATCH < points:
                continue
            score, a, b = align(item, text[left:right])
            if score >= points:
                found += [(left + a, left + b, score)] * (left + a < stop)
                parts += [(left, left + a), (left + b, right)]
        for a, b, score in sorted(found):
            yield score, a, b
        low = max([stop] + [b for _, b, _ in found])


def _matches(numbers: np.ndarray, items: list, seeds: _Seeds,
             least: float, chosen: set[int]) -> Iterator[tuple]:
    """(item, score, start, stop) of the copies of chosen items, which do not overlap."""
    for item, starts, offsets in _hits(numbers, seeds):
        if item not in chosen:
            continue
        text = items[item]
        points = _least_points(len(text), least)
        pad = max(len(text) // 2, len(text) - points) + 1
        for low, high, i, j in _windows(starts, len(text), pad, len(numbers)):
            if len(np.unique(offsets[i:j])) < seeds.least_hits[item]:
                continue
            for score, a, b in _copies(text, numbers[low:high], points):
                yield item, score / len(text), low + a, low + b


def _seeds(data: _Items, least: float) -> _Seeds:
    """All n-grams of the items, of the size that every copy keeps some of."""
    kept = [kept_grams(len(text), least) for text in data.texts]
    codes = [_codes(text, n) for text, (n, _) in zip(data.texts, kept)]
    sizes = [len(c) for c in codes]
    items = np.repeat(np.arange(len(codes)), sizes)
    offsets = np.concatenate([np.arange(n) for n in sizes]) if sizes else items
    codes = np.concatenate(codes) if sizes else np.zeros(0, np.int64)
    order = np.argsort(codes, kind="stable")
    grams, first = np.unique(codes[order], return_index=True)
    return _Seeds(tuple(sorted({n for n, _ in kept})), grams, np.append(first, len(codes)),
                  items[order], offsets[order], np.array([h for _, h in kept], np.int64))


def _gram_hits(keyed: DataFrame, block: Broadcast) -> DataFrame:
    """(k1, k2, grams): which n-grams of the items a text holds, for texts that hold any."""
    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, _, seeds, _ = block.value
        for batch in batches:
            for piece in pieces(batch, "text"):
                grams, keep = [], []
                for i, text in enumerate(piece.column("text").to_pylist()):
                    numbers = _numbers(text, words)
                    held = np.unique(np.concatenate([
                        _places(_codes(numbers, n), seeds.grams)[1] for n in seeds.sizes]))
                    if len(held):
                        grams.append(held)
                        keep.append(i)
                keys = piece.select(["k1", "k2"]).take(pa.array(keep, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*keys.columns, pa.array(grams, pa.list_(pa.int32()))], ["k1", "k2", "grams"])

    return keyed.mapInArrow(worker, "k1 bigint, k2 bigint, grams array<int>")


def rare_seeds(hits: DataFrame, seeds: _Seeds) -> DataFrame:
    """(gram, item): of every item the n-grams held by the fewest texts, as few as are safe.

    Of an item's n-grams every copy keeps a number at least; so of all but that many, and one
    more, every copy keeps one. Which they are is free, and the rarest meet the fewest texts.
    """
    spark = hits.sparkSession
    sizes = np.bincount(seeds.items, minlength=len(seeds.least_hits))
    gram = np.repeat(np.arange(len(seeds.grams)), np.diff(seeds.first))
    most = (sizes - seeds.least_hits + 1)[seeds.items]
    held = spark.createDataFrame(pa.table({
        "gram": pa.array(gram, pa.int32()), "item": pa.array(seeds.items, pa.int32()),
        "offset": pa.array(seeds.offsets, pa.int32()), "most": pa.array(most, pa.int32())}))
    counts = hits.select(F.explode("grams").alias("gram")).groupBy("gram").agg(
        F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(
        F.coalesce("n", F.lit(0)), "gram", "offset"))
    return held.join(counts, "gram", "left").withColumn("rank", rank).where(
        F.col("rank") <= F.col("most")).select("gram", "item").distinct()


def _aligned(candidates: DataFrame, block: Broadcast, least_score: float) -> DataFrame:
    """(k1, k2, matches) of texts with the items that share a rare seed with them."""
    kind = pa.list_(pa.struct([("item_id", pa.string()), ("score", pa.float64()),
                               ("start_word", pa.int32()), ("stop_word", pa.int32())]))
    names = [f.name for f in kind.value_type]

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, texts, seeds, ids = block.value
        for batch in batches:
            for piece in pieces(batch, "text"):
                found = [[dict(zip(names, (ids[i], *m))) for i, *m in _matches(
                    _numbers(text, words), texts, seeds, least_score, set(items))]
                         for text, items in zip(piece.column("text").to_pylist(),
                                                piece.column("items").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("k1"), piece.column("k2"), pa.array(found, kind)],
                    ["k1", "k2", "matches"])

    return candidates.mapInArrow(worker, f"k1 bigint, k2 bigint, matches {_MATCHES}").where(
        F.size("matches") > 0)


def _search(keyed: DataFrame, rows: list, least_score: float) -> DataFrame | None:
    """(k1, k2, matches): the copies of a block of items in the texts, written."""
    data = _read_items(rows)
    if not data.texts:
        return None
    seeds = _seeds(data, least_score)
    block = keyed.sparkSession.sparkContext.broadcast(
        (data.words, list(data.texts), seeds, data.ids))
    hits = stored(_gram_hits(keyed, block))
    chosen = stored(rare_seeds(hits, seeds))  # written, so its size tells how to join
    met = hits.select("k1", "k2", F.explode("grams").alias("gram")).join(chosen, "gram")
    candidates = stored(met.select("k1", "k2", "item").distinct().groupBy("k1", "k2").agg(
        F.sort_array(F.collect_list("item")).alias("items")))
    # Equal texts have one answer: each is aligned once.
    texts = keyed.join(candidates, ["k1", "k2"]).groupBy("k1", "k2").agg(
        F.first("text").alias("text"), F.first("items").alias("items"))
    found = stored(_aligned(texts, block, least_score))
    for table in (hits, chosen, candidates):
        discard(table)
    block.unpersist()
    return found


def annotate(docs: DataFrame, items: DataFrame, text_col: str = "text",
             item_col: str = "item_id", item_text: str = "text",
             least_score: float = LEAST_SCORE,
             items_at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """``matches, row``: every row and the copies of items in its text.

    A match has the item's id, the alignment's score over that of an exact copy, at least
    ``least_score``, and its first word and the word after its last. Words are compared in
    lower case without punctuation. A document has a match for each copy of an item; copies
    of one item do not overlap, the best is taken first. Items of one or two words are found
    where all their words stand in a row; null and empty texts hold and match nothing; very
    long texts are searched by themselves; repeated rows get equal answers; equal items are
    all reported; an empty table of items gives no matches; columns may have any names. Items
    come in blocks of a fixed size, one after the other, so what is broadcast is bounded;
    documents are never collected.
    """
    items = items.select(F.col(item_col).cast("string").alias("item_id"),
                         F.col(item_text).cast("string").alias("text"))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    text = F.col("row")[text_col].cast("string")
    keys = {"k1": F.xxhash64(text), "k2": F.xxhash64(F.lit(1), text)}
    keyed = rows.select(text.alias("text"), *[k.alias(n) for n, k in keys.items()]).where(
        F.col("text").isNotNull())
    none = F.array().cast(_MATCHES)
    tables, block = [], []
    for item in items.toLocalIterator():
        block.append(item)
        if len(block) == items_at_once:
            tables, block = [*tables, _search(keyed, block, least_score)], []
    if block:
        tables.append(_search(keyed, block, least_score))
    tables = [t for t in tables if t is not None]
    if not tables:
        return rows.select(none.alias("matches"), "row")
    found = tables[0]
    if len(tables) > 1:
        found = stored(reduce(DataFrame.unionByName, tables).groupBy("k1", "k2").agg(
            F.flatten(F.collect_list("matches")).alias("matches")))
    found = found.select("matches", *[F.col(n).alias(f"of_{n}") for n in keys])
    joined = rows.withColumns(keys).join(
        found, (F.col("k1") == F.col("of_k1")) & (F.col("k2") == F.col("of_k2")), "left")
    return joined.select(F.coalesce("matches", none).alias("matches"), "row")


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                 item_col: str = "item_id", **options) -> DataFrame:
    """``doc_id, item_id, score, start_word, stop_word``: one row per copy of an item."""
    kind = items.schema[item_col].dataType
    found = annotate(docs, items, item_col=item_col, **options)
    found = found.select(F.col("row")[id_col].alias("doc_id"), F.explode("matches").alias("m"))
    return found.select("doc_id", F.col("m.item_id").cast(kind).alias("item_id"), "m.score",
                        "m.start_word", "m.stop_word")
