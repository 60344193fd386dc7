"""Operator 12 against brute force, and its index against its own bounds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import hard_negatives
from sluice.llm.hard_negatives import mine_hard_negatives, padded, scores, train_codebook


def brute(rows, n_positives=5, n_negatives=10, low=30, high=90):
    vectors = {i: (label, [int(np.floor(256 * float(x))) for x in v]) for i, v, label in rows}
    out = []
    for a, (label, v) in vectors.items():
        if a % 100:
            continue
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in vectors.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if vectors[i][0] == label][:n_positives]:
            hard = [i for i in order if vectors[i][0] != label and low * score[p] <= 100 * score[i] <= high * score[p]]
            out += [(a, p, r + 1, i, score[p], score[i]) for r, i in enumerate(hard[:n_negatives])]
    return sorted(out)


def some_vectors(rng, n, dim, labels, spread):
    middle = rng.normal(size=(labels * 2, dim))
    label = rng.integers(0, labels, n)
    values = middle[label + labels * rng.integers(0, 2, n)] + spread * rng.normal(size=(n, dim))
    values[rng.random(n) < 0.3] = values[0]  # a third are one vector
    return [(int(i), [float(x) for x in v], int(c)) for i, (v, c) in enumerate(zip(values.astype(np.float32), label))]


@pytest.mark.parametrize("n, dim, labels, spread, block", [
    (900, 6, 3, 0.2, 4096), (900, 5, 4, 1.0, 40), (350, 1, 2, 0.3, 16), (300, 8, 200, 0.5, 64)])
def test_equals_brute_force(spark, monkeypatch, n, dim, labels, spread, block):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
    monkeypatch.setattr(hard_negatives, "FIRST_ROWS", 30)
    rows = some_vectors(np.random.default_rng(n + dim), n, dim, labels, spread)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    got = mine_hard_negatives(df, F.col("vec_id") % 100 == 0)
    want = brute(rows)
    assert sorted(tuple(r) for r in got.collect()) == want and want


def test_cells_are_visited_by_falling_bounds_and_hold_their_rows():
    rng = np.random.default_rng(9)
    x = rng.integers(-200, 200, (500, 7))
    books = train_codebook(x[:, :3], 8), train_codebook(x[:, 3:], 6)
    words = [((part[:, None] - book) ** 2).sum(axis=2).argmin(axis=1) for part, book in zip((x[:, :3], x[:, 3:]), books)]
    radii = tuple(
        np.array([max(np.linalg.norm(part[w == k] - book[k], axis=1), default=0) for k in range(len(book))])
        for part, book, w in zip((x[:, :3], x[:, 3:]), books, words))
    cell = np.full((len(books[0]), len(books[1])), -1)
    pairs = sorted(set(zip(*words)))
    for n, p in enumerate(pairs):
        cell[p] = n
    ones = np.ones(len(pairs), dtype=int)
    index = hard_negatives.Index(3, books, radii, cell, ones, np.arange(len(pairs)), ones)
    for q in x[:40].astype(float):
        upper, lower = index.bounds(q)
        seen = list(index.visits(upper))
        assert [s[1] for s in seen] and sorted(s[1] for s in seen) == list(range(len(pairs)))
        assert all(a[0] >= b[0] for a, b in zip(seen, seen[1:]))
        product = x @ q
        for bound, _, i, j in seen:
            inside = product[(words[0] == i) & (words[1] == j)]
            assert lower[0][i] + lower[1][j] <= inside.min() and inside.max() <= bound


def test_exact_scores():
    big = np.array([[2**30, -(2**30) + 1, 3]])
    assert scores(big, big)[0, 0] == sum(int(v) ** 2 for v in big[0])
    assert scores(big, big[:, :1])[0, 0] == 2**60


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [1.0, i / 100], i % 2) for i in range(1, 40)] + [(0, [1.0, 1.0], 0), (100, [0.5], 1), (200, [], 0)]
    bad = [(400, None, 0), (500, [nan, 1.0], 0), (600, [1.0, inf], 0), (700, [1.0, None], 0), (800, [1.0, 1.0], None),
           (None, [1.0, 1.0], 0), (900, [1e30, 1.0], 0), (0, [9.0, 9.0], 1), (3, [1.0, 0.03], 1), (3, [1.0, 0.03], 1)]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>, label int").selectExpr(
        "*", "'x' AS id", "1 AS v", "2 AS r", "3 AS anchor", "4 AS rank", "5 AS block", "6 AS `odd.name`")
    got = mine_hard_negatives(df, F.col("vec_id") % 100 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute(good)
    assert mine_hard_negatives(df.where("false"), F.col("vec_id") % 100 == 0).count() == 0
    assert mine_hard_negatives(df.where("vec_id = 0"), F.col("vec_id") % 100 == 0).count() == 0
    assert mine_hard_negatives(df.where("vec_id > 0"), F.col("vec_id") == -1).count() == 0


def test_padding(spark):
    import pyarrow as pa

    v = pa.array([[1, 2, 3], [], [4]], pa.list_(pa.int64()))
    assert padded(v).tolist() == [[1, 2, 3], [0, 0, 0], [4, 0, 0]] and padded(v, 2).tolist() == [[1, 2], [0, 0], [4, 0]]
