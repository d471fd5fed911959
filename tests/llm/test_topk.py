import math
import random

import pytest

from mesura.llm import topk as K

SCHEMA = "vec_id long, embedding array<float>, label int, v string, score string"


def brute(rows, k=5, mod=7):
    fine = {}
    for i, e, *_ in rows:
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            fine.setdefault(i, set()).add(tuple(math.floor(256 * x) for x in e))
    flat = [(i, v) for i, vs in fine.items() for v in vs]
    out = []
    for q in sorted({i for i in fine if i % mod == 0}):
        best = sorted(((-sum(a * b for a, b in zip(x, v)), i) for x in fine[q] for i, v in flat if i != q and len(v) == len(x)))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


def run(spark, rows, p=K.Params()):
    df = spark.createDataFrame([(i, e, 0, "x", "y") for i, e in rows], SCHEMA)
    return sorted(tuple(r) for r in K.top_k(df, lambda i: i % 7 == 0, p).collect())


def vector(rng, n=16):
    return [float(rng.randrange(-200, 200)) / 256 for _ in range(n)]


def test_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(k, vector(rng)) for k in range(300)]
    assert run(spark, rows) == brute(rows)
    small = K.Params(parts=4, local=2, block=8, cell=50)
    assert run(spark, rows, small) == brute(rows)


def test_ties_copies_and_odd_rows(spark):
    rng = random.Random(5)
    common, zero = vector(rng), [0.0] * 16
    rows = [(k, common) for k in range(0, 90)] + [(k, zero) for k in range(90, 110)] + [(k, [float(rng.randrange(2)) for _ in range(16)]) for k in range(110, 200)]
    rows += [(7, common), (210, None), (217, [None] * 16), (224, [float("nan")] + [0.0] * 15), (231, [float("inf")] * 16), (None, common), (238, [-1.0] * 16), (245, [1.0, 2.0]), (246, [3.0, 1.0]), (252, [])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, K.Params(parts=3, local=1, block=4, cell=16)) == brute(rows)


def test_large_components_are_exact(spark):
    rows = [(k, [float((1 << 20) + k), float(k % 5) * 2.0 ** 15, -1.0]) for k in range(30)]
    assert run(spark, rows) == brute(rows)


def test_few_rows_and_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 256 * 512)]


def test_scores_beyond_longs_are_an_error(spark):
    with pytest.raises(ValueError):
        run(spark, [(0, [1e30, 1.0]), (1, [1.0, 1.0])])
    assert run(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0])], K.Params(parts=4)) == [(0, 1, 1, 4 * 65536)]
