"""Byte-level BPE: encoding by ranked merges, decoding by concatenation.

The rank map is a literal of the plan: an array of small maps from a pair of token ids to the
id, and so the rank, of their merge. Spark's higher-order functions fold the merges over the
byte arrays of distinct words. The fold costs about a tenth of a millisecond a word, so it
encodes the most frequent words of the corpus, a bounded table that covers nearly all of a
text; Arrow batches look words up there and merge the rare rest by the same ranks.
"""

from __future__ import annotations

import base64
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, filterfalse, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surtido.llm.common import by_value, let, pieces, stored

by_value(__name__)

# Bounds of the table of frequent words: rows, and bytes of a word.
FREQUENT_WORDS = 1 << 17
WORD_BYTES = 64
# Stretches between spaces that a worker remembers beside that table.
REMEMBERED = 1 << 16
# Texts decoded, and bytes encoded, at a time.
ROWS_DECODED = 256
ENCODED_BYTES = 1 << 19
# Words up to these bytes are merged together, as rows of a matrix.
TOGETHER_BYTES = 64
# Matches above these bytes, stretches without a space, are merged through a heap.
LONG_MATCH = 256
# Words folded in one row.
BLOCK_WORDS = 2048

_NEVER = 1 << 62  # the rank of two tokens that are not merged
_SLOTS = 1 << 16
_MIX = 0x5BD1E995  # keys stay below 2**32, so the product fits in 63 bits


@lru_cache(maxsize=4)
def read_ranks(path: str) -> Mapping[bytes, int]:
    """The rank file: a token in base64 and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def split_pattern(pattern: str) -> regex.Pattern:
    """The pattern with the white space of Unicode, as the reference tokenizers have it."""
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(
        r"\S", r"\P{White_Space}"))


# --- Fold of ranked merges in Spark ------------------------------------------

def rank_table(spark: SparkSession, ranks: Mapping[bytes, int]) -> DataFrame:
    """One row, one column ``ranks``: pair of ids -> id of the merge, in hashed slots."""
    slots: list[list[tuple[int, int]]] = [[] for _ in range(_SLOTS)]
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                key = a << 16 | b
                slots[(key * _MIX >> 20) & (_SLOTS - 1)].append((key, rank))
    kind = pa.list_(pa.map_(pa.int64(), pa.int32()))
    return spark.createDataFrame(pa.table({"ranks": pa.array([slots], kind)}))


def _merged(ranks: Column, a: Column, b: Column) -> Column:
    """The id of the merge of two tokens, null if there is none."""
    key = F.shiftleft(a.cast("long"), 16) + b
    slot = F.shiftright(key * F.lit(_MIX), 20).bitwiseAND(_SLOTS - 1).cast("int")
    return ranks[slot][key]


def fold(ids: Column, ranks: Column) -> Column:
    """Token ids of a word after all merges: the lowest rank first, the leftmost of equals.

    The state is the tokens and, for each two neighbours, the rank of their merge; a merge
    replaces two tokens and renews two ranks.
    """
    none = F.array().cast("array<int>")

    def merge(tokens: Column, gaps: Column, new: Column, at: Column) -> Column:
        left = F.when(at > 1, F.array(_merged(ranks, tokens[at - 2], new))).otherwise(none)
        right = F.when(at < F.size(gaps), F.array(
            _merged(ranks, new, tokens[at + 1]))).otherwise(none)
        rest = F.size(tokens)
        return F.struct(
            F.concat(F.slice(tokens, F.lit(1), at - 1), F.array(new),
                     F.slice(tokens, at + 2, rest)).alias("tokens"),
            F.concat(F.slice(gaps, F.lit(1), F.greatest(at - 2, F.lit(0))), left, right,
                     F.slice(gaps, at + 2, rest)).alias("gaps"))

    def step(state: Column, _: Column) -> Column:
        tokens, gaps = state["tokens"], state["gaps"]
        return let(F.array_min(gaps), lambda new: F.when(new.isNull(), state).otherwise(
            let(F.array_position(gaps, new).cast("int"),
                lambda at: merge(tokens, gaps, new, at))))

    n = F.size(ids)
    gaps = F.when(n < 2, none).otherwise(F.zip_with(
        F.slice(ids, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(ids, F.lit(2), n),
        lambda a, b: _merged(ranks, a, b)))
    steps = F.when(n < 2, F.array().cast("array<int>")).otherwise(
        F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))))
    return F.aggregate(steps, F.struct(ids.alias("tokens"), gaps.alias("gaps")), step,
                       lambda state: state["tokens"])


def encode_words(words: DataFrame, ranks: Mapping[bytes, int]) -> DataFrame:
    """(word, ids) of the distinct words in column ``word``, a block of words at a time.

    The rank map joins a block as a scalar, which the plan holds as a literal.
    """
    spark = words.sparkSession
    single = F.array(*[F.lit(ranks[bytes([b])]) for b in range(256)])

    def tokens(word: Column) -> Column:
        signs = F.decode(word.cast("binary"), "ISO-8859-1")  # one character per byte
        return let(signs, lambda s: F.transform(
            F.sequence(F.lit(1), F.length(s)),
            lambda i: single[F.ascii(F.substring(s, i, F.lit(1)))]))

    count = FREQUENT_WORDS // BLOCK_WORDS
    blocks = words.where(F.length("word") > 0).distinct().withColumn(
        "block", F.pmod(F.xxhash64("word"), F.lit(count))).repartition(count, "block").groupBy(
        "block").agg(F.collect_list("word").alias("words"))
    blocks = blocks.withColumn("ranks", rank_table(spark, ranks).scalar())
    done = blocks.select(F.explode(F.transform("words", lambda w: F.struct(
        w.alias("word"), let(tokens(w), lambda t: fold(t, F.col("ranks"))).alias("ids")))).alias("w"))
    return done.select("w.*")


# --- Texts --------------------------------------------------------------------

def count_words(docs: DataFrame, pattern: str, text_col: str = "text") -> DataFrame:
    """(word, n): every match of the pattern in all texts and how often it occurs.

    A space before a sign that is not white space always begins a match of the pattern, so a
    text may be cut there, and equal stretches are split alike.
    """
    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = split_pattern(pattern).findall
        for batch in batches:
            stretches: Counter[str] = Counter()
            counts: Counter[str] = Counter()
            for piece in pieces(batch, "text"):
                for text in piece.column("text").to_pylist():
                    first, *rest = (text or "").split(" ")
                    if "" in rest or any(map(str.isspace, map(itemgetter(0), rest))):
                        counts.update(find(text))
                    else:
                        counts.update(find(first))
                        stretches.update(rest)
            for part, n in stretches.items():
                for word in find(" " + part):
                    counts[word] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                ["word", "n"])

    words = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(
        worker, "word string, n bigint")
    return words.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int = FREQUENT_WORDS) -> DataFrame:
    """The words above a count that at most ``most`` words reach; short ones only.

    A histogram of the counts, sixteen steps per doubling, tells the count, so that nothing
    is sorted as a whole.
    """
    counts = stored(counts.where(F.octet_length("word") <= WORD_BYTES))
    step = F.floor(16 * F.log2("n")).cast("int")
    total, least = 0, None
    for row in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).orderBy(
            F.desc("step")).collect():
        total += row["words"]
        if total > most:
            break
        least = row["step"]
    return counts.where(step >= least if least is not None else F.lit(False)).select("word")


def merge_bytes(word: bytes, ranks: Mapping[bytes, int]) -> list[int]:
    """Token ids of a rare word, by the same merges as :func:`fold`."""
    if len(word) > LONG_MATCH:
        return merge_long(word, ranks)
    get, cuts = ranks.get, list(range(len(word) + 1))  # a part lies between two cuts
    gaps = [get(word[i:i + 2], _NEVER) for i in cuts[:-2]]
    while gaps and (best := min(gaps)) < _NEVER:
        i = gaps.index(best)
        del cuts[i + 1], gaps[i]
        if i:
            gaps[i - 1] = get(word[cuts[i - 1]:cuts[i + 1]], _NEVER)
        if i < len(gaps):
            gaps[i] = get(word[cuts[i]:cuts[i + 2]], _NEVER)
    return [ranks[word[a:b]] for a, b in zip(cuts, cuts[1:])]


def merge_long(word: bytes, ranks: Mapping[bytes, int]) -> list[int]:
    """:func:`merge_bytes` of a long match, in about linear time.

    The possible merges wait in a heap by rank and place; the parts are a linked list. A merge
    whose parts have changed since it was noted is passed over.
    """
    n, get = len(word), ranks.get
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    ends = list(range(1, n + 1))  # of the part that begins here; 0 once it is merged away
    waiting = [(rank, i, i + 2) for i in range(n - 1)
               if (rank := get(word[i:i + 2])) is not None]
    heapify(waiting)
    while waiting:
        _, i, stop = heappop(waiting)
        j = ends[i] and after[i]
        if not j or j >= n or ends[j] != stop:
            continue
        ends[i], ends[j], after[i] = stop, 0, after[j]
        if after[j] < n:
            before[after[j]] = i
        for a in (before[i], i):
            b = after[a] if a >= 0 else n
            if b < n and (rank := get(word[a:ends[b]])) is not None:
                heappush(waiting, (rank, a, ends[b]))
    return [ranks[word[i:ends[i]]] for i in range(n) if ends[i]]


Pairs = tuple[np.ndarray, np.ndarray, np.ndarray]


def pair_table(ranks: Mapping[bytes, int]) -> Pairs:
    """(ids of the bytes, pairs of ids as sorted keys, the ranks of their merges)."""
    found = [(a << 16 | b, rank) for token, rank in ranks.items()
             for cut in range(1, len(token))
             if (a := ranks.get(token[:cut])) is not None
             and (b := ranks.get(token[cut:])) is not None]
    keys, merged = np.array(sorted(found), np.int64).reshape(-1, 2).T
    return (np.array([ranks[bytes([b])] for b in range(256)], np.int64),
            np.append(keys, _NEVER), np.append(merged, _NEVER))


def _pair_ranks(pairs: Pairs, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The rank of the merge of each two ids; ids below 0 are no tokens."""
    keys = np.where(b < 0, -1, a << 16 | b)
    at = np.searchsorted(pairs[1], keys)
    return np.where(pairs[1][at] == keys, pairs[2][at], _NEVER)


def merge_many(words: list[bytes], pairs: Pairs) -> list[bytes]:
    """The ids, as bytes, of many short words, by the same merges as :func:`merge_bytes`.

    A word is a row of ids; in each step every row that can merges its lowest rank, the
    leftmost of equals, and gets shorter by one. Rows that cannot are done.
    """
    sizes = np.array([len(w) for w in words], np.int64)
    width = int(sizes.max(initial=1))
    inside = np.arange(width) < sizes[:, None]
    rows = np.full(inside.shape, -1, np.int64)
    rows[inside] = pairs[0][np.frombuffer(b"".join(words), np.uint8)]
    gaps = _pair_ranks(pairs, rows[:, :-1], rows[:, 1:])
    number, done, lengths, order = np.arange(len(words)), [], [], []

    def finish(ended: np.ndarray) -> None:
        valid = rows[ended] >= 0
        done.append(rows[ended][valid])
        lengths.append(valid.sum(axis=1))
        order.append(number[ended])

    while gaps.shape[1] and len(rows):
        at = gaps.argmin(axis=1)
        new = gaps[np.arange(len(rows)), at]
        going = new < _NEVER
        if not going.all():
            finish(~going)
            rows, gaps, number, at, new = (x[going] for x in (rows, gaps, number, at, new))
            if not len(rows):
                break
        every = np.arange(len(rows))
        rows[every, at] = new
        width = rows.shape[1] - 1
        rows = rows[np.arange(width + 1) != at[:, None] + 1].reshape(len(at), width)
        gaps = gaps[np.arange(width) != at[:, None]].reshape(len(rows), width - 1)
        left = np.flatnonzero(at > 0)
        gaps[left, at[left] - 1] = _pair_ranks(pairs, rows[left, at[left] - 1], new[left])
        right = np.flatnonzero(at < width - 1)
        gaps[right, at[right]] = _pair_ranks(pairs, new[right], rows[right, at[right] + 1])
    if len(rows):
        finish(np.ones(len(rows), bool))
    ends = 4 * np.cumsum(np.concatenate([[0], *lengths]))
    data = np.concatenate([*done, np.zeros(0, np.int64)]).astype(np.int32).tobytes()
    out = [b""] * len(words)
    for i, a, b in zip(np.concatenate([*order, np.zeros(0, np.int64)]).tolist(),
                       ends[:-1].tolist(), ends[1:].tolist()):
        out[i] = data[a:b]
    return out


def _as_bytes(ids: Iterable[int]) -> bytes:
    return array("i", ids).tobytes()


class _Encoder:
    """Ids, as bytes, of texts; stretches of texts are split, merged together, and remembered.

    A task remembers up to ``REMEMBERED`` stretches.
    """

    def __init__(self, known: dict[str, bytes], ranks: Mapping[bytes, int], pairs: Pairs,
                 pattern: str):
        self.known, self.ranks, self.pairs = known, ranks, pairs
        self.find = split_pattern(pattern).findall
        self.memory: dict[str, bytes] = {}

    def merged(self, words: Iterable[str]) -> dict[str, bytes]:
        """The ids of words that are not known, short ones together, widths of a power of two."""
        found: dict[str, bytes] = {}
        alike: dict[int, list[str]] = {}
        for word in words:
            size = len(word.encode())
            if size > TOGETHER_BYTES:
                found[word] = _as_bytes(merge_bytes(word.encode(), self.ranks))
            else:
                alike.setdefault((size - 1).bit_length(), []).append(word)
        for own in alike.values():
            found.update(zip(own, merge_many([w.encode() for w in own], self.pairs)))
        return found

    def texts(self, texts: list[str]) -> list[bytes]:
        cut = [t.partition(" ") for t in texts]
        rests = [rest.split(" ") if space else [] for _, space, rest in cut]
        coded = [[*map(self.memory.get, parts)] for parts in rests]
        gaps = [[k for k, ids in enumerate(own) if ids is None] for own in coded]
        new = {parts[k] for parts, own in zip(rests, gaps) for k in own}
        spaced = {p for p in new if not p or p[0].isspace()}
        regular = list(new - spaced)
        # Where a space does not begin a match, the whole text is split by the pattern.
        firsts = [first for first, _, _ in cut]
        if spaced:
            for i, parts in enumerate(rests):
                if not spaced.isdisjoint(parts):
                    firsts[i], coded[i], gaps[i] = texts[i], [], []
        words = [*map(self.find, map(" ".__add__, regular))]
        first_words = [*map(self.find, firsts)]
        known = self.known
        rare = self.merged(set(filterfalse(known.__contains__, chain(
            chain.from_iterable(words), chain.from_iterable(first_words)))))

        def joined(found: list[str]) -> bytes:
            return b"".join([known.get(w) or rare[w] for w in found])

        recent = dict(zip(regular, map(joined, words)))
        if len(self.memory) < REMEMBERED:
            self.memory.update(islice(recent.items(), REMEMBERED - len(self.memory)))
        for parts, ids, own in zip(rests, coded, gaps):
            for k in own:
                ids[k] = recent[parts[k]]
        return [joined(first) + b"".join(ids) for first, ids in zip(first_words, coded)]


def encode(docs: DataFrame, ranks: Mapping[bytes, int], pattern: str,
           text_col: str = "text", frequent: int = FREQUENT_WORDS) -> DataFrame:
    """``ids`` (array of int), ``decoded``, ``row`` (the given row as a struct) for every row.

    ``decoded`` is the bytes of the ids, as :func:`decode` gives them. Each match of the pattern
    is encoded by itself, without special tokens. A null or empty text has no ids; repeated rows
    are encoded alike; an empty table gives no rows; a very long text is encoded by itself, in
    time about linear in its longest match; columns may have any names.
    """
    spark = docs.sparkSession
    common = frequent_words(count_words(docs, pattern, text_col), frequent)
    found = encode_words(common, ranks).toArrow()
    # Arrays, from which a task makes its dictionaries: workers keep broadcast values for long.
    words = found.column("word").combine_chunks(), pa.array(
        map(_as_bytes, found.column("ids").to_pylist()), pa.binary())
    tokens = pa.array(ranks.keys(), pa.binary()), pa.array(ranks.values(), pa.int32())
    shared = spark.sparkContext.broadcast((words, tokens, pair_table(ranks), _token_table(ranks)))

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tokens, pairs, table = shared.value
        known, ranks = (dict(zip(keys.to_pylist(), values.to_pylist()))
                        for keys, values in (words, tokens))
        encoder = _Encoder(known, ranks, pairs, pattern)
        for batch in batches:
            for piece in pieces(batch, "text", ENCODED_BYTES):
                coded = encoder.texts([t or "" for t in piece.column("text").to_pylist()])
                ends = np.cumsum([0, *map(len, coded)]) // 4
                ids = np.frombuffer(b"".join(coded), np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                     _decoded(ids, ends, table), piece.column("row")], ["ids", "decoded", "row"])

    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    rows = rows.select(F.col("row")[text_col].cast("string").alias("text"),
                       F.col("row").dropFields(text_col).alias("row")
                       if len(docs.columns) > 1 else F.lit(None).cast("string").alias("row"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(worker, f"ids array<int>, decoded binary, row {kind}")


def _token_table(ranks: Mapping[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, sizes, bytes) of all tokens, by id."""
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    sizes = np.array([len(t) for t in tokens], np.int64)
    return np.cumsum(sizes) - sizes, sizes, np.frombuffer(b"".join(tokens), np.uint8)


def _decoded(ids: np.ndarray, cuts: np.ndarray, table: tuple) -> pa.Array:
    """The joined bytes of the ids between every two cuts."""
    starts, sizes, data = table
    length = sizes[ids]
    ends = np.append(0, np.cumsum(length))
    place = np.repeat(starts[ids] - ends[:-1], length) + np.arange(ends[-1])
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [
        None, pa.py_buffer(ends[cuts].astype(np.int64)), pa.py_buffer(data[place])]).cast(pa.binary())


def decode(rows: DataFrame, ranks: Mapping[bytes, int], ids_col: str = "ids",
           out: str = "decoded") -> DataFrame:
    """The rows with the bytes of their ids, joined, in column ``out``.

    Null and empty ids give no bytes; repeated rows are decoded alike; an empty table gives no
    rows; a column of the name ``out`` is replaced.
    """
    shared = rows.sparkSession.sparkContext.broadcast(_token_table(ranks))
    names = [c for c in rows.columns if c != out]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_DECODED):
                batch = whole.slice(at, ROWS_DECODED)
                lists = batch.column(names.index(ids_col))
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
                decoded = _decoded(lists.flatten().to_numpy(),
                                   np.append(0, np.cumsum(counts)), shared.value)
                yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*names, out])

    return rows.select(*[f"`{c}`" for c in names]).mapInArrow(worker, f"{schema}, `{out}` binary")
