import math
import random

import numpy as np
import pytest

from mesura.llm import near_dedup as N


def words(text):
    return [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").replace("\t", " ").replace("\n", " ").split(" ") if w]


def shingles(text):
    w = words(text)
    return {tuple(w)} if len(w) == 1 else set(zip(w, w[1:]))


def brute(rows):
    """doc_id -> (component); links between ids with similar texts."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


def edited(rng, base, n):
    out = list(base)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, n long, bucket string, comp string")


def full(rows):
    return [(i, t, 7, "clash", "clash") for i, t in rows]


def check(spark, rows, p=N.Params()):
    got = [tuple(r) for r in N.near_duplicates(table(spark, full(rows)), p).collect()]
    want = brute(rows)
    assert len(got) == len(rows)
    assert sorted((i if i is not None else -99, n) for i, n, _, _ in got) == sorted((i if i is not None else -99, len(shingles(t))) for i, t in rows)
    for i, n, comp, kept in got:
        if i is None:
            assert comp is None and kept
        else:
            assert comp == want[i], (i, comp, want[i])
            assert kept == (i == comp)


def test_groups_chains_and_odd_rows(spark):
    rng = random.Random(3)
    base = [f"w{k}" for k in range(120)]
    rows = [(10, " ".join(base)), (11, " ".join(base)), (5, " ".join(base).upper())]
    rows += [(20 + k, edited(rng, base, 4)) for k in range(30)]  # near copies whose own pairs fall short
    chain = list(base[:60])
    for k in range(12):  # a chain of small steps
        chain = [f"c{k}_{j}" if j // 3 == k else w for j, w in enumerate(chain)]
        rows.append((100 + k, " ".join(chain)))
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "one"), (204, "ONE"), (205, "one one"), (206, "a b"), (207, "A\tB"), (None, "a b"), (None, None)]
    rows += [(300, "x y z " * 50), (301, "x y z " * 51), (302, "long " * 3 + " ".join(f"q{k}" for k in range(20000)))]
    rows += [(206, "a b"), (400, "p q r s"), (400, "one")]  # a repeated row; an id with two texts
    check(spark, rows)


def test_limit_is_inclusive(spark):
    base = [f"w{k}" for k in range(37)]  # 36 shingles
    for extra in (8, 9, 10):  # 36 of 45 is exactly 0.8
        check(spark, [(1, " ".join(base)), (2, " ".join(base + [f"x{k}" for k in range(extra)]))])


def test_empty_table(spark):
    got = N.near_duplicates(table(spark, []))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"] and got.count() == 0


@pytest.mark.parametrize("share", [0.5, 0.8, 0.95])
def test_registers_estimate_similarity_and_merge(share):
    p = N.Params(registers=2000)
    sketch, rng = N.SetSketch(p), np.random.default_rng(5)
    both, rest = int(2000 * share), 2000 - int(2000 * share)
    x = rng.integers(0, 1 << 63, 2000 + rest, dtype=np.uint64)
    a, b = np.sort(x[:2000]), np.sort(x[rest:])
    ra, rb = sketch.registers(a), sketch.registers(b)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert both == len(np.intersect1d(a, b))
    best, _ = N.similarity(ra[None], rb[None], np.array([2000.0]), np.array([2000.0]), p.base)
    assert abs(best[0] - true) < 0.07
    assert (sketch.merge(ra, rb) == sketch.registers(np.union1d(a, b))).all()


def test_connected_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(1000 + k, 1001 + k) for k in range(40)]
    got = {r["id"]: r["comp"] for r in N.connected(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {x: x for e in links for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    want = {x: find(x) for x in parent if any(x in e and e[0] != e[1] for e in links)}
    assert got == want


def test_bands_miss_as_stated():
    """Exact: of 400 registers k are equal with the binomial's probability, and
    of the ways to place k some fill no band."""
    p, share = N.Params(), 0.8
    bands = p.registers // p.rows
    ways = [1]
    for _ in range(bands):
        ways = np.convolve(np.array(ways, object), np.array([math.comb(p.rows, k) for k in range(p.rows)], object))
    ways = np.convolve(ways, np.array([math.comb(p.registers % p.rows, k) for k in range(p.registers % p.rows + 1)], object))
    miss = sum(math.comb(400, k) * share ** k * (1 - share) ** (400 - k) * (ways[k] / math.comb(400, k)) ** p.groupings for k in range(len(ways)))
    assert miss <= 5e-9


def test_repeated_rows_meet_once(spark, monkeypatch):
    """Two near copies, each 1,000 times: as many pairs as of one each."""
    rng = random.Random(8)
    base = [f"w{k}" for k in range(200)]
    texts = [" ".join(base), edited(rng, base, 3), edited(rng, base, 3)]
    seen = []
    links = N._links

    def counted(spark, pairs, reps, texts, p, name):
        seen.append((pairs.count(), reps.count(), texts.count()))
        return links(spark, pairs, reps, texts, p, name)

    monkeypatch.setattr(N, "_links", counted)
    once = [(i, t) for i, t in enumerate(texts)]
    check(spark, once)
    got = N.near_duplicates(table(spark, full(once * 1000))).groupBy("doc_id", "component_id", "kept").count().collect()
    assert {tuple(r) for r in got} == {(i, 0, i == 0, 1000) for i in range(3)}
    assert seen[0] == seen[1] == (2, 3, 3)


def test_hot_keys_are_joined_in_cells(spark):
    rows = spark.range(5000).selectExpr("cast(if(id % 10 < 7, 1, id) as long) as k", "id")
    side = rows.select("k").distinct().selectExpr("k", "k * 2 as twice")
    got = N._spread(rows, "k", "id", side)
    assert got.columns == ["k", "id", "twice"]
    assert sorted(map(tuple, got.collect())) == sorted((1 if i % 10 < 7 else i, i, 2 if i % 10 < 7 else 2 * i) for i in range(5000))
