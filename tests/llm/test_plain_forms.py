"""Plain forms of the learned and drawn results, and texts above the pieces of a worker."""

import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from surtido.llm import (
    bpe, common, decontamination, langid, lines, sharding, simhash, suffixes, toxicity,
)
from tests.llm import brute
from tests.llm.conftest import FOLDER, sorted_rows

PIECE = "every word of this long text comes again and again, 17 times 3; "
LONG = PIECE * (common.PIECE_BYTES // len(PIECE) + 20)
LONG_DOCS = [(1, LONG), (2, "short"), (3, "x" + LONG + "\nthe last line of the text"),
             (4, "y" * 400 + " " + PIECE), (5, None), (6, "the last line of the text")]


@pytest.fixture(scope="module")
def long_docs(spark):
    assert len(LONG) > common.PIECE_BYTES
    return spark.createDataFrame(LONG_DOCS, "doc_id long, text string").repartition(3)


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def test_long_texts_lose_repeated_strings(long_docs):
    got = suffixes.remove_repeated(long_docs).select(
        "row.doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long"),
        F.size("spans"), F.sha2("kept", 256))
    assert sorted_rows(got, "*") == brute.repeated_bytes(LONG_DOCS)


def test_long_texts_lose_lines_and_copies(long_docs):
    got = lines.drop_lines(long_docs, lines.keep_bitmaps(long_docs)).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256))
    assert sorted_rows(got, "*") == brute.line_dedup(LONG_DOCS)
    assert sorted_rows(simhash.near_duplicates(long_docs), "*") == brute.simhash_components(
        LONG_DOCS)


def test_long_texts_are_encoded(long_docs, ranks):
    encoding = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN,
                                 mergeable_ranks=dict(ranks), special_tokens={})
    rows = bpe.encode(long_docs, ranks, public_tokenizers.PATTERN).select(
        "row.doc_id", "ids", "decoded").collect()
    texts = dict(LONG_DOCS)
    for row in rows:
        assert row.ids == encoding.encode_ordinary(texts[row.doc_id] or "")
        assert bytes(row.decoded) == (texts[row.doc_id] or "").encode()


def test_long_texts_are_searched_and_judged(spark, long_docs):
    items = spark.createDataFrame([(7, "the last line of the text"), (8, "no such words here")],
                                  "item_id long, text string")
    got = decontamination.contaminated(long_docs, items).collect()
    assert {(r.doc_id, r.item_id, r.score) for r in got} == {(3, 7, 1.0), (6, 7, 1.0)}
    model = langid.learn(spark.createDataFrame(
        [(i, t, "en") for i, t in enumerate([PIECE] * 5)], "doc_id long, text string, lang string"))
    got = {r.doc_id: r.lang_pred for r in langid.predict(long_docs, model).collect()}
    assert got == {1: "en", 2: "en", 3: "en", 4: "en", 5: "und", 6: "en"}
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 5)],
                                   "doc_id long, quality int, toxic int")
    chain = toxicity.learn(long_docs, labels, least_documents=1)
    assert toxicity.predict(long_docs, chain).count() == len(LONG_DOCS)


def test_long_matches_equal_tiktoken(ranks):
    encoding = tiktoken.Encoding("plain", pat_str=r"(?s).+", mergeable_ranks=dict(ranks),
                                 special_tokens={})
    rng = random.Random(1)
    texts = ["a" * 200_000, "漢字かな交じり文" * 9000, "=" * 5000,
             "".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(200_000))]
    texts += ["".join(rng.choice("theinganor") for _ in range(n)) for n in range(1, 400, 7)]
    for text in texts:
        assert bpe.merge_long(text.encode(), ranks) == encoding.encode_ordinary(text)
        if len(text) < 400:
            assert bpe.merge_bytes(text.encode(), ranks) == encoding.encode_ordinary(text)


def plain_grams(text):
    """Letters in lower case, everything between them one gap; n-grams without inner gaps."""
    signs = "".join(c if c.isalpha() else " " for c in f" {(text or '').lower()} ")
    while "  " in signs:
        signs = signs.replace("  ", " ")
    return [signs[i:i + n] for n in langid.SIZES for i in range(len(signs) - n + 1)
            if " " not in signs[i + 1:i + n - 1]]


def test_languages_by_exact_sets(spark):
    """The filter's corrected popcounts decide as the sets themselves do."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [r for r in docs.select("doc_id", "text", "lang").collect()]
    model = langid.learn(docs, grams_per_language=1 << 20)  # no ties at the end of a set
    counts: dict[str, Counter] = {}
    for r in rows:
        if r.lang is not None:
            counts.setdefault(r.lang, Counter()).update(plain_grams(r.text))
    same = close = 0
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, model).collect()}
    for r in rows:
        grams = plain_grams(r.text)
        hits = [sum(g in counts[lang] for g in grams) for lang in model.languages]
        if not any(c.isalpha() for c in r.text or ""):
            assert got[r.doc_id] == ("und", 0.0)
            same, close = same + 1, close + 1
            continue
        best = int(np.argmax(hits))
        same += got[r.doc_id][0] == model.languages[best]
        close += abs(got[r.doc_id][1] - hits[best] / max(1, sum(hits))) < 0.02
    assert same >= 0.99 * len(rows)
    assert close >= 0.97 * len(rows)


def newton(x, y, penalty):
    """A ridge logistic regression by full Newton steps; the constant is hardly penalised."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.append(np.full(x.shape[1] - 1, penalty), 1e-3)
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (p - y) + ridge * w
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), slope)
    return w


def test_the_chain_equals_direct_fits():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((600, 5))
    first = (x @ rng.standard_normal(5) + rng.standard_normal(600) > 0).astype(float)
    second = (first + x[:, 0] + rng.standard_normal(600) > 1).astype(float)
    labels = np.column_stack([first, second])
    labels[::7, 0], labels[::5, 1] = np.nan, np.nan
    folds = np.arange(600) % 4
    weights = toxicity.fit_chain(x, labels, folds)

    known = ~np.isnan(labels)
    held_out = np.zeros(600)
    for fold in range(4):
        train = known[:, 0] & (folds != fold)
        w = newton(x[train], labels[train, 0], toxicity.PENALTY)
        held_out[folds == fold] = 1 / (1 + np.exp(-x[folds == fold] @ w[:-1] - w[-1]))
    chained = np.column_stack([x, np.log(held_out / (1 - held_out)).clip(-8, 8)])
    want = [newton(x[known[:, 0]], labels[known[:, 0], 0], toxicity.PENALTY),
            newton(chained[known[:, 1]], labels[known[:, 1], 1], toxicity.PENALTY)]
    for own, plain in zip(weights, want):
        assert np.allclose(own, plain, atol=5e-3 * np.abs(plain).max())


def plain_shard(key, tree):
    """Down the tree: the child with the least draw, by the weights of their shards."""
    path = ()
    for depth in (1, 2, 3):
        weights: dict[tuple, float] = {}
        for leaf, weight in tree.items():
            if leaf[:depth - 1] == path:
                weights[leaf[:depth]] = weights.get(leaf[:depth], 0.0) + weight

        def draw(child):
            start = xxhash.xxh64_intdigest(key.encode(), 42)
            bits = xxhash.xxh64_intdigest("/".join(map(str, child)).encode(), start) >> 11
            return -math.log((bits + 0.5) / 2 ** 53) / weights[child]

        path = min((c for c, w in weights.items() if w > 0), key=lambda c: (draw(c), c))
    return path[2]


def test_shards_by_a_plain_descent(spark):
    tree = dict(sharding.balanced_tree(8))
    uneven = {leaf: 1.0 + i % 3 for i, leaf in enumerate(tree)} | {(5, 0, 90): 0.0}
    for own in (tree, uneven, sharding.grow(tree)):
        rows = sharding.assign(spark.range(400), F.col("id"), own, "shard").collect()
        assert [r.shard for r in rows] == [plain_shard(str(r.id), own) for r in rows]
