"""Packing of tokenized documents into sequences by length patterns.

A pattern is a few lengths that fill a sequence exactly. How often each is repeated is fitted
to the histogram of the lengths by non-negative least squares; the counts are rounded so that
no length is used more often than it occurs, and what is left is packed best fit, length by
length. The plan so made depends on the histogram only, whose size is that of a sequence.
Every piece has a number among those of its length, which finds its place in the plan.
"""

from __future__ import annotations

import json
import os
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from surtido.llm.common import by_value, pieces, stored

by_value(__name__)

SEQUENCE = 2048
END_ID = 0
# Documents in a pattern, at most.
PATTERN_MOST = 3
# Steps of a fit.
FIT_STEPS = 100
# A fit is repeated on the patterns it repeats most, down to so many per length; of the plans
# from these supports and shares of the fitted repeats, that with the fewest sequences is taken.
SUPPORTS = (2.0, 1.0, 0.5)
SHARES = (1.0, 0.9, 0.5)
# Bytes of text tokenized at a time.
TEXT_BYTES = 1 << 20


# How many sequences, and the (length, how many) that each of them holds.
Groups = list[tuple[int, list[tuple[int, int]]]]


# --- Plan ---------------------------------------------------------------------

def exact_patterns(lengths: np.ndarray, size: int) -> np.ndarray:
    """Rows of up to three of the lengths that add up to ``size``, rising, 0 for none.

    Single lengths, pairs and triples; a length may come more than once.
    """
    has = np.zeros(size + 1, bool)
    has[lengths] = True
    found = [np.array([[0, 0, size]])] if has[size] else []
    low = lengths[lengths <= size // 2]
    low = low[has[size - low]]
    found.append(np.stack([np.zeros_like(low), low, size - low], axis=1))
    if PATTERN_MOST > 2:
        for a in lengths[lengths <= size // 3]:
            b = lengths[(lengths >= a) & (lengths <= (size - a) // 2)]
            b = b[has[size - a - b]]
            found.append(np.stack([np.full_like(b, a), b, size - a - b], axis=1))
    return np.concatenate(found) if found else np.zeros((0, PATTERN_MOST), np.int64)


def fit_repeats(patterns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Repeats >= 0 of the patterns with the least squared error to the counts of the lengths.

    Accelerated projected gradient steps. A pattern has at most three lengths, so products
    with the matrix of patterns are look-ups and histograms, and the matrix is never built.
    The error of a length is weighed by the root of its count.
    """
    size = len(counts)
    weight = np.zeros(size)
    weight[1:] = 1 / np.sqrt(np.maximum(counts[1:], 1))

    def used(x: np.ndarray) -> np.ndarray:
        total = sum(np.bincount(patterns[:, k], x, size) for k in range(patterns.shape[1]))
        total[0] = 0
        return total

    def gradient(x: np.ndarray) -> np.ndarray:
        return (weight * weight * (used(x) - counts))[patterns].sum(axis=1)

    # The largest eigenvalue of the normal matrix, by power steps, bounds the step.
    probe = np.ones(len(patterns))
    bound = 1.0
    for _ in range(20):
        product = weight * weight * used(probe)
        probe = product[patterns].sum(axis=1)
        bound = float(np.linalg.norm(probe))
        probe /= bound
    step = 1 / (1.05 * bound)

    x = ahead = np.zeros(len(patterns))
    pace = 1.0
    for _ in range(FIT_STEPS):
        slope = gradient(ahead)
        new = np.maximum(ahead - step * slope, 0)
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        if (new - x) @ (ahead - new) > 0:  # the momentum points uphill: start it anew
            faster = 1.0
        ahead = new + (pace - 1) / faster * (new - x) if faster > 1 else new
        x, pace = new, faster
    return x


def sparse_fits(patterns: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray,
                                                                            np.ndarray]]:
    """(patterns, repeats) of fits on ever fewer patterns.

    A fit spreads over very many patterns with repeats below one, which rounding would lose.
    As few patterns as there are lengths can do as well, so the fit is repeated on those it
    repeats most.
    """
    repeats = fit_repeats(patterns, counts)
    for share in SUPPORTS:
        most = max(1, int(share * np.count_nonzero(counts)))
        while len(patterns) > most:
            kept = np.argsort(-repeats, kind="stable")[:max(most, len(patterns) // 4)]
            patterns = patterns[kept]
            repeats = fit_repeats(patterns, counts)
        yield patterns, repeats


def round_repeats(patterns: np.ndarray, repeats: np.ndarray,
                  counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whole repeats, counts left): rounded down, and no length used beyond its count."""
    left, whole = counts.copy(), np.floor(repeats).astype(np.int64)
    for j in np.argsort(-repeats, kind="stable").tolist():
        if not whole[j]:
            continue
        parts = [p for p in patterns[j].tolist() if p]
        whole[j] = min(int(whole[j]), *(int(left[p]) // parts.count(p) for p in parts))
        for p in parts:
            left[p] -= whole[j]
    return whole, left


def best_fit(left: np.ndarray, size: int) -> Groups:
    """(sequences, [(length, how many)]) of what is left, best fit, longest lengths first.

    Sequences of one content are one entry, so the work depends on the number of lengths.
    """
    bins: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    rooms: list[int] = []  # the free rooms, rising

    def put(free: int, count: int, content: list[tuple[int, int]]) -> None:
        if free not in bins:
            bins[free] = []
            insort(rooms, free)
        bins[free].append((count, content))

    def take(room: int) -> tuple[int, list[tuple[int, int]]]:
        entry = bins[room].pop()
        if not bins[room]:
            del bins[room]
            rooms.remove(room)
        return entry

    for length in range(size, 0, -1):
        todo = int(left[length])
        while todo:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                count, content = take(room)
            else:
                room, content = size, []
                count = -(-todo // (size // length))
            each = room // length
            full, rest = min(count, todo // each), 0
            if full < count and todo > full * each:
                rest = todo - full * each
            if full:
                put(room - each * length, full, content + [(length, each)])
            if rest:
                put(room - rest * length, 1, content + [(length, rest)])
            if count - full - bool(rest):
                put(room, count - full - bool(rest), content)
            todo -= full * each + rest
    return [entry for entries in bins.values() for entry in entries if entry[1]]


@dataclass(frozen=True)
class Plan:
    """Where the pieces of a length go: runs of their numbers, sorted by length and number.

    The pieces of a run lie ``each`` in a sequence, the first of them at ``offset``.
    """

    sequences: int
    length: np.ndarray
    first: np.ndarray     # number of the run's first piece among those of its length
    sequence: np.ndarray  # the run's first sequence
    each: np.ndarray
    offset: np.ndarray

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces by their length and number."""
        wide = 1 << 40
        run = np.searchsorted(self.length * wide + self.first, length * wide + number,
                              side="right") - 1
        inside = number - self.first[run]
        return (self.sequence[run] + inside // self.each[run],
                self.offset[run] + inside % self.each[run] * length)


def _content(pattern: np.ndarray) -> list[tuple[int, int]]:
    values, each = np.unique(pattern[pattern > 0], return_counts=True)
    return list(zip(values.tolist(), each.tolist()))


def make_plan(counts: np.ndarray) -> Plan:
    """The plan for ``counts`` of pieces by length, 0 to the size of a sequence."""
    size, counts = len(counts) - 1, counts.astype(np.int64)
    patterns = exact_patterns(np.flatnonzero(counts), size)
    groups: Groups = []
    for own, repeats in sparse_fits(patterns, counts) if len(patterns) else ():
        for share in SHARES:
            whole, left = round_repeats(own, share * repeats, counts)
            made: Groups = [(int(whole[j]), _content(own[j])) for j in np.flatnonzero(whole)]
            made += best_fit(left, size)
            if not groups or sum(n for n, _ in made) < sum(n for n, _ in groups):
                groups = made
    groups = groups or best_fit(counts, size)

    runs: list[tuple[int, int, int, int, int]] = []
    used = np.zeros(size + 1, np.int64)
    sequences = 0
    for count, content in groups:
        offset = 0
        for length, each in content:
            runs.append((length, int(used[length]), sequences, each, offset))
            used[length] += count * each
            offset += length * each
        sequences += count
    columns = np.array(sorted(runs), np.int64).reshape(-1, 5)
    return Plan(sequences, *columns.T)


# --- Documents ----------------------------------------------------------------

def _byte_signs() -> dict[str, int]:
    """The byte of every sign of a byte-level vocabulary.

    Printable bytes stand for themselves, the others for the signs from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def byte_ranks(tokenizer: str) -> dict[bytes, int] | None:
    """Ranks of a plain byte-level BPE; None if the file asks for more, or ids do not rank."""
    file = json.loads(tokenizer)
    model, split = file["model"], file.get("pre_tokenizer") or {}
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
               "byte_fallback", "ignore_merges")
    if (model.get("type") != "BPE" or any(map(model.get, options)) or file.get("normalizer")
            or split.get("type") != "ByteLevel" or split.get("add_prefix_space")
            or not split.get("use_regex", True) or file.get("truncation") or file.get("padding")
            or any(t["content"] in model["vocab"] and not t["special"]
                   for t in file.get("added_tokens", ()))):
        return None
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [model["vocab"].get("".join(pair)) for pair in pairs]
    signs, special = _byte_signs(), {t["content"] for t in file.get("added_tokens", ())}
    words = [w for w in model["vocab"] if w not in special]
    if None in made or made != sorted(made) or any(c not in signs for w in words for c in w):
        return None
    return {bytes(map(signs.__getitem__, w)): model["vocab"][w] for w in words}


def id_coder(tokenizer: str) -> Callable[[str], np.ndarray]:
    """The ids of a text by a tokenizer's JSON text, its special tokens taken as ordinary text.

    A plain byte-level BPE runs on the ranks of its own vocabulary, with the same ids in a
    quarter of the time; runs of white space too long for that form, and any other tokenizer,
    go through the tokenizer itself.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    whole = Tokenizer.from_str(tokenizer)
    whole.encode_special_tokens = True

    def slow(text: str) -> np.ndarray:
        return np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)

    ranks = byte_ranks(tokenizer)
    if ranks is None:
        return slow
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})

    def ids(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text)
        except ValueError:
            return slow(text)

    return ids


def tokenized(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_id: int = END_ID,
              text_col: str = "text") -> DataFrame:
    """The pieces of every row: ``row, piece, start, length, ids, part, number``.

    ``ids`` are little-endian 32-bit numbers. ``number`` counts the pieces of one length in
    the task ``part``. ``tokenizer`` is the tokenizer's JSON text.
    """
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    rows = rows.select(F.coalesce(F.col("row")[text_col].cast("string"), F.lit("")).alias("text"),
                       F.col("row").dropFields(text_col).alias("row")
                       if len(docs.columns) > 1 else F.lit(None).cast("string").alias("row"))
    kind = rows.schema["row"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = id_coder(shared.value)
        part, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in batches:
            for some in pieces(batch, "text", TEXT_BYTES):
                owner, piece, start, ids = [], [], [], []
                for i, text in enumerate(some.column("text").to_pylist()):
                    own = np.append(coder(text), np.uint32(end_id)).astype("<u4", copy=False)
                    cuts = [*range(len(own) % size, len(own), size), len(own)]
                    cuts = cuts if cuts[0] == 0 else [0, *cuts]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        owner.append(i)
                        piece.append(k)
                        start.append(a)
                        ids.append(own[a:b].tobytes())
                length = np.array([len(x) // 4 for x in ids], np.int64)
                turn = np.argsort(length, kind="stable")
                of, first = np.unique(length[turn], return_index=True)
                number = np.empty(len(length), np.int64)
                number[turn] = np.arange(len(length)) - np.repeat(
                    first, np.diff(np.append(first, len(length)))) + seen[length[turn]]
                seen += np.bincount(length, minlength=size + 1)
                yield pa.RecordBatch.from_arrays(
                    [some.column("row").take(pa.array(owner, pa.int64())),
                     pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length),
                     pa.array(ids, pa.binary()), pa.array([part] * len(ids), pa.int32()),
                     pa.array(number)],
                    ["row", "piece", "start", "length", "ids", "part", "number"])

    return rows.mapInArrow(worker, f"row {kind}, piece int, start bigint, length bigint, "
                                   "ids binary, part int, number bigint")


def pack(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_id: int = END_ID,
         text_col: str = "text") -> tuple[DataFrame, Plan]:
    """(``row, piece, start, length, ids, sequence_id, offset`` of every piece, the plan).

    A document is its ids and ``end_id``; one longer than ``size`` is cut into pieces of that
    size, of which the first may be shorter. A null text counts as empty and is ``end_id``
    alone; repeated rows are packed as often as they are given; a very long text is tokenized
    alone; an empty table gives no rows; columns may have any names.
    """
    found = stored(tokenized(docs, tokenizer, size, end_id, text_col))
    tally = stored(found.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")))
    counts = np.zeros(size + 1, np.int64)
    for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r["length"]] = r["n"]
    plan = make_plan(counts)

    # Rows of the tally, one per task and length, tell where a task's numbers begin.
    before = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    firsts = tally.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias(
        "before"))
    numbered = found.join(firsts, ["part", "length"]).select(
        "row", "piece", "start", "length", "ids",
        (F.col("number") + F.col("before")).alias("number"))
    shared = docs.sparkSession.sparkContext.broadcast(plan)

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sequence, offset = shared.value.place(
                    batch.column("length").to_numpy(), batch.column("number").to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                    ["row", "piece", "start", "length", "ids", "sequence_id", "offset"])

    kind = numbered.schema["row"].dataType.simpleString()
    return numbered.mapInArrow(worker, f"row {kind}, piece int, start bigint, length bigint, "
                                       "ids binary, sequence_id bigint, offset bigint"), plan
