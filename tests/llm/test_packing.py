"""Packing against the tokenizer itself and the bounds of any packing."""

import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from surtido.llm import packing, queries
from tests.llm.conftest import EDGES, FOLDER

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, docs, size=2048):
    """Pieces of the right ids; sequences without gaps, within the size, few."""
    coder = Tokenizer.from_file(PATH)
    coder.encode_special_tokens = True
    want = []
    for i, text in docs:
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 0]
        cuts = sorted({0, *range(len(ids) % size, len(ids), size), len(ids)})
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
                   for r in rows) == Counter(want)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        ends = 0
        for offset, length in sorted(own):
            assert offset == ends
            ends += length
        assert ends <= size
    return len(sequences), sum(w[3] for w in want)


def packed(spark, docs, size=2048):
    with open(PATH, encoding="utf-8") as file:
        found, plan = packing.pack(docs, file.read(), size)
    return found.select("row.doc_id", "piece", "start", "length", F.crc32("ids").alias(
        "ids_crc32"), "sequence_id", "offset").collect(), plan


def test_documents_are_packed(spark, edges, empty):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select(
        "doc_id", "text").collect()]
    count, tokens = check(queries.op11_packing(spark, FOLDER).collect(), docs)
    assert count <= -(-tokens // 2048) + 1
    rows, plan = packed(spark, edges.repartition(7))
    assert check(rows, EDGES)[0] == plan.sequences
    rows, plan = packed(spark, edges.repartition(3), 64)
    assert check(rows, EDGES, 64)[0] == plan.sequences
    assert packed(spark, empty)[0] == []


def test_copies_and_very_long_texts(spark):
    long = "the quick brown fox <|endoftext|> jumps " * 120_000  # above the bytes at a time
    docs = [(i, "one text of copies") for i in range(500)] + [(500, long), (501, None), (501, None)]
    rows, plan = packed(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    count, tokens = check(rows, docs)
    assert count == plan.sequences <= -(-tokens // 2048) + 1


def test_ids_are_those_of_the_tokenizer():
    with open(PATH, encoding="utf-8") as file:
        source = file.read()
    whole, coder = Tokenizer.from_str(source), packing.id_coder(source)
    whole.encode_special_tokens = True
    assert packing.byte_ranks(source) is not None
    texts = [f"a{c}b1{c}2.{c}, {c} {c}{c}  {c}x\n{c} 's{c}" for c in map(
        chr, [*range(0x3000), *range(0xA000, 0xD800, 7), *range(0xE000, 0x110000, 61)])]
    texts += [whole.decode([i]) for i in range(0, 50_257, 3)]
    texts += [" " * 1_500_000 + "x", "<|endoftext|> a", "漢字" * 9000, "a" * 5000]
    for text, coded in zip(texts, whole.encode_batch(texts, add_special_tokens=False)):
        assert coder(text).tolist() == coded.ids
    other = source.replace('"add_prefix_space":false', '"add_prefix_space":true').replace(
        '"add_prefix_space": false', '"add_prefix_space": true')
    assert packing.byte_ranks(other) is None
    prefixed = Tokenizer.from_str(other)
    assert packing.id_coder(other)("word two").tolist() == prefixed.encode("word two").ids


def least_sequences(lengths, size):
    """The fewest sequences, by trying all assignments."""
    lengths = sorted(lengths, reverse=True)
    for n in range(-(-sum(lengths) // size), len(lengths) + 1):
        rooms = {tuple([size] * n)}
        for length in lengths:
            rooms = {tuple(sorted(r[:k] + (r[k] - length,) + r[k + 1:])) for r in rooms
                     for k in range(n) if r[k] >= length}
        if rooms:
            return n


@pytest.mark.parametrize("seed", range(12))
def test_few_pieces_are_packed_as_well_as_can_be(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 17, 9)
    plan = packing.make_plan(np.bincount(lengths, minlength=17))
    assert plan.sequences <= least_sequences(lengths.tolist(), 16)


@pytest.mark.parametrize("kind", ["uniform", "skewed", "equal", "long", "short", "hot"])
def test_plans_cover_every_piece_once(kind):
    rng = np.random.default_rng(3)
    size = 256
    lengths = {"uniform": rng.integers(1, 257, 20_000), "skewed": np.minimum(
        256, 1 + rng.geometric(0.02, 20_000)), "equal": np.full(1000, 100),
        "long": rng.integers(129, 257, 3000), "short": rng.integers(1, 9, 5000),
        "hot": np.append(np.full(7000, 97), rng.integers(1, 257, 14_000))}[kind]
    counts = np.bincount(lengths, minlength=size + 1)
    plan = packing.make_plan(counts)
    length = np.repeat(np.arange(size + 1), counts)
    number = np.concatenate([np.arange(c) for c in counts])
    sequence, offset = plan.place(length, number)
    order = np.lexsort((offset, sequence))
    sequence, offset, length = sequence[order], offset[order], length[order]
    first = np.append(True, sequence[1:] != sequence[:-1])
    assert (offset[first] == 0).all() and len(np.unique(sequence)) == plan.sequences
    assert ((offset + length)[:-1][~first[1:]] == offset[1:][~first[1:]]).all()
    assert (offset + length <= size).all()
    # No packing has fewer: the tokens, the pieces of which two do not fit in one, and those
    # from 97 on, of which three do not fit.
    wide = (length >= 97).sum() - (length > size - 97).sum()
    bound = max(-(-int(length.sum()) // size), int((length > size // 2).sum()),
                int((length > size - 97).sum() + -(-wide // 2)))
    assert plan.sequences <= 1.01 * bound + 1


def test_fitted_repeats_are_least_squares():
    rng = np.random.default_rng(5)
    counts = np.append(0, rng.integers(50, 100, 24)).astype(float)
    patterns = packing.exact_patterns(np.arange(1, 25), 24)
    assert {tuple(p) for p in patterns.tolist()} == {
        tuple(sorted(p)) for p in product(range(25), repeat=3) if sum(p) == 24 and (
            p.count(0) < 3) and not (p.count(0) == 1 and 24 in p)}
    matrix = np.zeros((25, len(patterns)))
    for j, p in enumerate(patterns):
        np.add.at(matrix[:, j], p[p > 0], 1)
    weight = 1 / np.sqrt(np.maximum(counts, 1))[:, None]
    repeats = packing.fit_repeats(patterns, counts)
    gap = (weight * matrix) @ repeats - weight[:, 0] * counts
    slope = (weight * matrix).T @ gap
    # No pattern would lower the error by being repeated more, and none in use by less.
    assert (repeats >= 0).all() and slope.min() > -1e-2
    assert np.abs(slope[repeats > 1e-3]).max() < 1e-2
