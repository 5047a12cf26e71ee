"""Language identification by n-gram sets in a bit-sliced Bloom filter.

The filter has words of 64 language bits per slot, as many as the languages need. The slots of an n-gram's hashes, combined
by AND, give at once all languages whose set holds the n-gram. The popcount of each language
over a text, less the hits its filter gives by chance, decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surtido.llm.common import by_value, pieces

by_value(__name__)

UNKNOWN = "und"
WORD_LANGUAGES = 64
# Bounds of the training sample: documents per language, about, and n-grams per language.
DOCS_PER_LANGUAGE = 2_000
GRAMS_PER_LANGUAGE = 4_000
SLOT_BITS = 18
HASHES = 3
SIZES = (3, 4)

_state: dict = {}
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)


@dataclass(frozen=True)
class Model:
    """Languages, most frequent first; the filter; the chance of a false hit per language.

    The filter has a row per slot and a column per 64 languages (2 MB each).
    """

    languages: tuple[str, ...]
    slots: np.ndarray
    chance: np.ndarray


def _letters() -> np.ndarray:
    if "letters" not in _state:
        _state["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _state["letters"]


def _grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, text of each, whether each text has letters) of the n-grams in words.

    Letters are lower-cased; whatever lies between them is one gap, which an n-gram may
    begin or end with.
    """
    codes, owner = [], []
    for i, text in enumerate(texts):
        code = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le"), np.uint32)
        codes.append(code)
        owner.append(len(code))
    code = np.concatenate(codes).astype(np.uint64) if codes else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(texts)), owner)
    code[~_letters()[code]] = 0
    stay = np.ones(len(code), bool)
    stay[1:] = (code[1:] != 0) | (code[:-1] != 0) | (owner[1:] != owner[:-1])
    code, owner = code[stay], owner[stay]
    lettered = np.zeros(len(texts), bool)
    lettered[owner[code != 0]] = True
    hashes, owners = [], []
    for n in SIZES:
        if len(code) < n:
            continue
        last = len(code) - n + 1
        h = np.full(last, n, np.uint64)
        fine = np.ones(last, bool)
        for k in range(n):
            part = code[k:k + last]
            h = (h ^ part) * np.uint64(_ODD[k % 4])
            h ^= h >> np.uint64(29)
            if 0 < k < n - 1:
                fine &= part != 0
        hashes.append(h[fine])
        owners.append(owner[:last][fine])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), lettered
    return np.concatenate(hashes), np.concatenate(owners), lettered


def _slots(grams: np.ndarray) -> list[np.ndarray]:
    return [((grams * np.uint64(_ODD[k])) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
            for k in range(HASHES)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            texts = piece.column("text").to_pylist()
            langs: dict[str, int] = {}
            which = np.array([langs.setdefault(x, len(langs))
                              for x in piece.column("lang").to_pylist()])
            grams, owners, _ = _grams(texts)
            order = np.argsort(which[owners], kind="stable")
            edges = np.searchsorted(which[owners][order], np.arange(len(langs) + 1))
            for lang, a, b in zip(langs, edges[:-1], edges[1:]):
                found, n = np.unique(grams[order[a:b]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()),
                     pa.array(found.view(np.int64)), pa.array(n, pa.int64())],
                    ["lang", "gram", "n"])


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", docs_per_language: int = DOCS_PER_LANGUAGE,
          grams_per_language: int = GRAMS_PER_LANGUAGE) -> Model:
    """The n-gram sets of the languages in ``lang_col``, as a bit-sliced filter.

    Learns from about ``docs_per_language`` documents of each language, however many there
    are, chosen by a hash of their doc_id; a set holds the language's most frequent n-grams.
    Rows without a language are left out; no rows give a model without languages.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(lang_col).cast("string").alias("lang")).where("lang IS NOT NULL")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "lang").collect()
    languages = tuple(r["lang"] for r in sizes)
    slots = np.zeros((1 << SLOT_BITS, -(-len(languages) // WORD_LANGUAGES)), np.uint64)
    if languages:
        shares = F.map_from_arrays(F.lit(list(languages)),
                                   F.lit([docs_per_language / r["n"] for r in sizes]))
        share = F.element_at(shares, F.col("lang"))
        place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
        counts = rows.where(place < share).select("text", "lang").mapInArrow(
            _count, "lang string, gram bigint, n bigint")
        counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
        top = counts.withColumn("rank", rank).where(F.col("rank") <= grams_per_language)
        number = {lang: i for i, lang in enumerate(languages)}
        for r in top.groupBy("lang").agg(F.collect_list("gram").alias("grams")).toLocalIterator():
            word, bit = divmod(number[r["lang"]], WORD_LANGUAGES)
            for slot in _slots(np.array(r["grams"], np.int64).view(np.uint64)):
                slots[slot, word] |= np.uint64(1) << np.uint64(bit)
    fill = np.array([np.count_nonzero(slots[:, i // WORD_LANGUAGES]
                                      >> np.uint64(i % WORD_LANGUAGES) & np.uint64(1)) / len(slots)
                     for i in range(len(languages))])
    return Model(languages, slots, fill ** HASHES)


def _decide(texts: list[str | None], languages: tuple[str, ...], table: np.ndarray,
            chance: np.ndarray) -> tuple[list[str], list[float]]:
    grams, owners, lettered = _grams(texts)
    table = table.reshape(len(table), -1)
    slots = _slots(grams)
    total = np.bincount(owners, minlength=len(texts)).astype(float)
    sums, most = np.zeros(len(texts)), np.full(len(texts), -1.0)
    best = np.zeros(len(texts), np.int64)
    for low in range(0, len(languages), WORD_LANGUAGES):
        masks = np.full(len(grams), np.uint64(0xFFFFFFFFFFFFFFFF))
        for slot in slots:
            masks &= table[slot, low // WORD_LANGUAGES]
        there = np.flatnonzero(masks)
        masks, holders = masks[there], owners[there]
        for i in range(low, min(low + WORD_LANGUAGES, len(languages))):
            bit = (masks >> np.uint64(i - low)) & np.uint64(1)
            hits = np.bincount(holders[bit != 0], minlength=len(texts))
            true = np.maximum(0.0, (hits - total * chance[i]) / (1 - chance[i]))
            sums += true
            best = np.where(true > most, i, best)
            most = np.maximum(most, true)
    score = np.divide(most, sums, out=np.zeros(len(texts)), where=sums > 0)
    names = [languages[b] if l else UNKNOWN for b, l in zip(best, lettered)]
    return names, np.where(lettered, score, 0.0).tolist()


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, lang_pred, score``.

    The language with the largest corrected popcount, ties to the one more frequent in
    training; ``score`` is its share of all corrected popcounts, 0 if no n-gram is known.
    ``und`` with score 0 where the text is null or has no letter, or nothing was learned.
    Whole texts are read; repeated rows get equal answers; an empty table gives no rows;
    other columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.slots, model.chance))

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", 2 << 20):
                texts = piece.column("text").to_pylist()
                if shared.value[0]:
                    names, scores = _decide(texts, *shared.value)
                else:
                    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(names, pa.string()),
                     pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(worker, f"doc_id {kind}, lang_pred string, score double")
