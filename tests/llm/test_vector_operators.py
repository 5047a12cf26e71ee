"""Clustering and whitening of vectors against plain forms."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from surtido.llm import clustering, queries, whitening
from tests.llm.conftest import FOLDER, sorted_rows


@pytest.fixture(scope="module")
def vectors(spark):
    """Vectors with nulls, ties, copies, other lengths, odd entries and columns of clashing names."""
    rng = random.Random(7)
    rows = [(i, [rng.choice((-0.75, -0.25, 0.0, 0.5, 1.0)) for _ in range(64)])
            for i in range(40)]
    rows += [(100 + i, rows[3][1]) for i in range(30)] + [(5, rows[5][1])] * 3
    rows += [(200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 65), (None, rows[8][1]),
             (204, [None] + [0.5] * 63), (205, [math.nan] + [0.5] * 63),
             (206, [math.inf] * 64), (207, [-3.0e38] * 64), (208, [-0.0005] * 64),
             (-9, [100.25] + [0.0] * 63)]
    data = [(i, v, 1, "x", 2.0, 3) for i, v in rows]
    return rows, spark.createDataFrame(
        data, "vec_id long, embedding array<float>, x int, row string, whitened double, "
              "cluster int").repartition(5)


def plain_clusters(rows, clusters=8, rounds=10):
    kept = [(i, [math.floor(1024 * c) for c in v]) for i, v in rows
            if v is not None and len(v) == 64
            and all(c is not None and math.isfinite(c) and abs(c) < 2 ** 17 for c in v)]
    hashed = [(i is None, hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept]
    means = [v for _, _, v in sorted(hashed)[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), k) for k, m in enumerate(means))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for k, own in groups.items():
            means[k] = [sum(c) // len(own) for c in zip(*own)]
    found = [(i, *near(v)) for i, v in kept]
    sums = {}
    for _, d, k in found:
        sums[k] = sums.get(k, 0) + d
    hashes = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in means]
    return sorted([(i, k, d, sums[k], sum(sums.values()), hashes[k]) for i, d, k in found],
                  key=str)


def clustered(rows, **options):
    found, _ = clustering.cluster(rows, **options)
    return sorted_rows(found.select(
        "vec_id", "cluster", "distance", F.col("cluster_inertia").cast("long"),
        F.col("inertia").cast("long"), clustering.centroid_hash(F.col("centroid"))), "*")


def test_clusters(spark, vectors):
    rows, df = vectors
    assert clustered(df) == plain_clusters(rows)
    assert clustered(df, rounds=0) == plain_clusters(rows, rounds=0)
    assert clustered(df, clusters=30, rounds=2) == plain_clusters(rows, 30, 2)
    assert clustered(df.where("vec_id between 0 and 3")) == plain_clusters(rows[:4])
    assert clustered(df.limit(0)) == []
    data = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding")
    assert sorted_rows(queries.op13_clustering(spark, FOLDER), "*") == plain_clusters(
        [tuple(r) for r in data.collect()])


@pytest.mark.parametrize("dimensions, spread, clusters", [
    (1, 9, 40), (2, 5, 60), (3, 1000, 200), (8, 2, 50), (64, 100, 8), (4, 1, 5)])
def test_the_tree_finds_the_nearest_and_the_smaller_number(dimensions, spread, clusters):
    rng = np.random.default_rng(dimensions * spread)
    centroids = rng.integers(-spread, spread + 1, (clusters, dimensions))
    x = rng.integers(-spread, spread + 1, (700, dimensions))
    number, best = clustering.nearest(x, clustering.build_tree(centroids))
    away = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (number == away.argmin(axis=1)).all() and (best == away.min(axis=1)).all()


def test_the_tree_leaves_out_branches(monkeypatch):
    rng = np.random.default_rng(2)
    tree = clustering.build_tree(rng.integers(0, 1 << 20, (256, 2)))
    seen, whole = [], clustering.squares
    monkeypatch.setattr(clustering, "squares", lambda g: seen.append(len(g)) or whole(g))
    clustering.nearest(rng.integers(0, 1 << 20, (500, 2)), tree)
    assert sum(seen) < 500 * 256 / 4


def test_far_vectors_keep_exact_distances():
    edge = clustering.LARGEST - 1
    tree = clustering.build_tree(np.full((1, 64), edge))
    number, best = clustering.nearest(np.full((1, 64), -edge), tree)
    assert (number[0], int(best[0])) == (0, 64 * (2 * edge) ** 2)


def plain_whitening(rows, components=16):
    """vec_id, deviation, |whitened|; signs and equal eigenvalues are free."""
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows
            if v and len(v) == 64
            and all(c is not None and math.isfinite(c) and abs(c) < 2 ** 34 for c in v)]
    fit = np.array(sorted(set(tuple(v) for _, v in kept)), dtype=np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    covariance = centred.T @ centred / n
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    x = np.array([v for _, v in kept], dtype=np.int64)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    white = ((n * x - sums) / n) @ basis / np.sqrt(values)
    return n, [i for i, _ in kept], deviation, np.abs(white), values / np.trace(covariance)


def check_whitening(got, rows):
    n, ids, deviation, white, explained = plain_whitening(rows)
    want = sorted((str(i), int(d), k + 1, float(w), float(explained[k]))
                  for i, d, ws in zip(ids, deviation, white) for k, w in enumerate(ws))
    have = sorted((str(r.vec_id), r.deviation, r.component, abs(r.whitened), r.explained)
                  for r in got)
    assert [w[:3] for w in want] == [h[:3] for h in have]
    assert np.allclose([w[3:] for w in want], [h[3:] for h in have], rtol=1e-7, atol=1e-7)
    assert {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_whitening(spark, vectors, monkeypatch, tmp_path):
    rows, df = vectors
    usual = [r for r in rows if r[0] != 207]
    df.where("vec_id is null or vec_id <> 207").write.parquet(f"{tmp_path}/embeddings.parquet")
    check_whitening(queries.op12_whitening(spark, str(tmp_path)).collect(), usual)
    data = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding")
    check_whitening(queries.op12_whitening(spark, FOLDER).collect(),
                    [tuple(r) for r in data.collect()])


def test_whitening_of_few_vectors(spark, vectors, tmp_path):
    _, df = vectors
    white, model = whitening.whiten(df.limit(0))
    assert model is None and white.count() == 0
    df.limit(0).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert queries.op12_whitening(spark, str(tmp_path)).count() == 0
    white, model = whitening.whiten(df.where("vec_id = 5"))
    assert (model.n, white.count()) == (1, 4)
    assert {(r.deviation, tuple(r.whitened)) for r in white.collect()} == {(0, ())}
    white, model = whitening.whiten(df.where("vec_id between 0 and 4"))
    assert len(model.values) == 4 and model.identity_error < 1e-9
    large = spark.createDataFrame([(1, [2.0 ** 33]), (2, [-2.0 ** 33]), (3, [0.0])],
                                  "vec_id long, embedding array<double>")
    white, model = whitening.whiten(large)
    assert {r.row.vec_id: r.deviation for r in white.collect()} == {1: None, 2: None, 3: 0}
    assert math.isclose(model.values[0], 2 * 2.0 ** 78 / 3)


@pytest.mark.parametrize("kind", ["equal", "pairs", "falling", "flat", "single", "random"])
def test_contours_find_all_components(kind):
    rng = np.random.default_rng(11)
    d = 1 if kind == "single" else 40
    basis = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = {"equal": np.full(d, 3.0), "pairs": np.repeat(np.arange(1.0, d // 2 + 1), 2),
              "falling": 2.0 ** -np.arange(d), "flat": np.append(np.zeros(max(d - 3, 0)), [1, 2, 2]),
              "single": np.array([5.0]), "random": rng.random(d)}[kind]
    matrix = (basis * values) @ basis.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.leading(matrix, 16)
    want = np.sort(values[values > 0])[::-1][:16]
    assert np.allclose(found, want, rtol=0, atol=1e-13 * want[0])
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-13 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-13
    diagonal, off = whitening.tridiagonal(matrix)
    for shift in (0.3, 0.9, 2.5, 1e-3):
        assert whitening.count_below(diagonal, off, shift) == (values < shift).sum()
