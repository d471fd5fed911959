import math
from fractions import Fraction

import numpy as np
import pytest

from mesura.llm import whitening
from mesura.llm.common import QUERIES

SCHEMA = "vec_id long, embedding array<double>, vector string, n int"


def brute(vectors):
    """n, S, covariance by exact fractions, from the vectors' x."""
    x = [[math.floor(1024 * c) + 100000 for c in v] for v in vectors]
    n = len(x)
    s = [sum(c) for c in zip(*x)]
    mean = [Fraction(v, n) for v in s]
    v = [[float(sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in x) / n) for j in range(len(s))] for i in range(len(s))]
    return x, n, s, np.array(v)


@pytest.mark.parametrize("wide", [1.0, 3000.0, 2.0 ** 50])
def test_scatter_is_exact(wide):
    rng = np.random.default_rng(1)
    x = np.floor(1024 * rng.normal(0, wide, (200, 5))).astype(np.int64) + 100000
    x[:, 2] = 7  # a dimension without any plane
    planes = whitening.Planes.of(x.min(0), x.max(0))
    kind = np.int64 if wide < 1e4 else object
    sums, products = whitening.scatter(planes.pack(x), planes, 5, kind)
    u = (x - x.min(0)).astype(object)
    assert list(sums) == list(u.sum(0))
    whole = u.T.dot(u)
    assert all(products[i, j] == whole[i, j] for i in range(5) for j in range(i, 5))


def test_whitened_rows_against_exact_fractions(spark):
    rng = np.random.default_rng(2)
    good = rng.normal(0, 0.3, (40, 3)) @ np.array([[1, 0.5, 0], [0, 1, 0.2], [0, 0, 2.0]])
    good = [[float(c) for c in v] for v in good] + [[0.1, 0.2, 0.3]] * 20 + [[-500.0, 0.0, 1.0]]
    rows = [(k, v, "x", 1) for k, v in enumerate(good)]
    rows += [(3, good[3], None, None), (None, good[5], "y", 2)]  # a repeated row, a null id
    out = [(900, None, "", 0), (901, [0.1, None, 0.2], "", 0), (902, [math.nan, 0.0, 0.0], "", 0), (903, [math.inf, 0.0, 0.0], "", 0),
           (904, [1e300, 0.0, 0.0], "", 0), (905, [], "", 0), (906, [0.5], "", 0)]
    df = spark.createDataFrame(rows + out, SCHEMA).repartition(3)
    got, w, error = whitening.whiten(df, 8)
    x, n, s, v = brute([r[1] for r in rows])
    assert w.n == n and list(w.total) == s
    assert np.abs(w.covariance - v).max() <= 1e-12 * np.abs(v).max()
    assert error < 1e-9 and abs(w.explained.sum() - 1) < 1e-12
    values, vectors = np.linalg.eigh(v)
    project = (vectors / np.sqrt(values))[:, ::-1]
    by_id = {}
    for r in got.collect():
        by_id.setdefault(r["vec_id"], []).append(r)
    assert set(by_id) == {r[0] for r in rows} and len(by_id[3]) == 2
    expected = {r[0]: k for k, r in enumerate(rows)}
    signs = None
    for key, found in by_id.items():
        centred = [Fraction(c) - Fraction(t, n) for c, t in zip(x[expected[key]], s)]
        exact = sum((n * c - t) ** 2 for c, t in zip(x[expected[key]], s))
        want = np.array([float(c) for c in centred]) @ project
        for r in found:
            assert r["deviation"] == exact and int(r["exact_deviation"]) == exact
            if signs is None:
                signs = np.sign(want * np.array(r["white"]))
            assert np.allclose(np.array(r["white"]), want * signs, rtol=1e-9, atol=1e-9)


def test_deviation_beyond_a_long_is_null_but_exact_as_text(spark):
    df = spark.createDataFrame([(0, [2.0 ** 40, 0.0]), (1, [-2.0 ** 40, 0.25])], "vec_id long, embedding array<double>")
    got, w, _ = whitening.whiten(df)
    x, n, s, _ = brute([[2.0 ** 40, 0.0], [-2.0 ** 40, 0.25]])
    for r in got.collect():
        assert r["deviation"] is None
        assert int(r["exact_deviation"]) == sum((n * c - t) ** 2 for c, t in zip(x[r["vec_id"]], s))
    assert np.isnan(w.spread()[1])  # two rows span one direction


def test_direction_without_variance(spark):
    df = spark.createDataFrame([(k, [0.5, 0.1 * k]) for k in range(4)] + [(9, [0.5, 0.0])], "vec_id long, embedding array<double>")
    got, w, error = whitening.whiten(df)
    assert all(np.isnan(r["white"][1]) and np.isfinite(r["white"][0]) for r in got.collect())
    assert error < 1e-9
    same, w, error = whitening.whiten(spark.createDataFrame([(1, [0.5])] * 3, "vec_id long, embedding array<double>"))
    assert same.count() == 3 and error is None and list(w.explained) == [0.0]


def test_empty_tables(spark, tmp_path):
    for k, rows in enumerate(([], [(1, None)], [(1, [])])):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        assert whitening.whiten(df)[0].count() == 0
        df.write.parquet(f"{tmp_path}/{k}/embeddings.parquet")
        assert QUERIES["op11_embedding_whitening"](spark, f"{tmp_path}/{k}").count() == 0
