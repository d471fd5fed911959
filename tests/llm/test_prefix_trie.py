import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from mesura.llm import prefix_trie as T
from mesura.llm.common import QUERIES
from mesura.plans.prefix import Scratch

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int, id long"


def modulo(a, m):
    return abs(a) % m * (1 if a >= 0 else -1)  # of SQL: the sign of a


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [(role, text) for _, _, role, text in sorted(x, key=lambda r: r[:2])] for c, x in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = convs.get(c - modulo(c, 5), [])[:h] + own[h:]
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        under = [p for p in nodes if p[:len(path)] == path]
        kids = lambda p: [x for x in nodes if len(x) == len(p) + 1 and x[:len(p)] == p]
        saved = sum((len(nodes[p]) - 1) * (len(p[-1][1].encode()) if p else 0) for p in under)
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(path))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(kids(path)), sum(not kids(p) for p in under), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def run(spark, rows, small):
    df = spark.createDataFrame([(*r, "k", 7, 9) for r in rows], SCHEMA).repartition(4)
    nodes, ends = T.trie(df, small)
    got = nodes.join(T.digests(ends), "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))
    return sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=str)


def conversations(seed, n=90):
    rng = random.Random(seed)
    rows = []
    for c in [*range(n), -1, -5, -7, 10 ** 15, 10 ** 15 + 3]:
        if c % 7 == 3:
            continue  # a base or a copy that is absent
        for t in range(rng.choice([1, 2, 4, 12])):
            rows.append((c, t if t else None, rng.choice(["user", "assistant", None]), rng.choice(["a", "é", "", None, "long text"])))
    rows += [(5, 100 + t, "user", "same") for t in range(3)] + [(None, 1, "user", "x")]
    rows += [(c, 0, "user", "common") for c in range(1000, 1060)] + [(c, 1, "user", str(c)) for c in range(1000, 1060)]
    return rows + [(2000, t, "user", f"turn {t % 3}") for t in range(60)] + [(2001, t, "user", f"turn {t % 3}") for t in range(55)]


@pytest.mark.parametrize("seed, small", [(1, 4096), (2, 8)])
def test_against_brute_force(spark, seed, small):
    rows = conversations(seed)
    assert run(spark, rows, small) == brute(rows)


def test_repeated_rows_are_turns(spark):
    rows = [(0, 1, "user", "a")] * 9 + [(1, 1, "user", "a")] * 12
    assert run(spark, rows, 4096) == brute(rows)


def test_list_ranks(spark):
    rng = random.Random(4)
    order = rng.sample(range(10 ** 6), 300)
    arcs = spark.createDataFrame(list(zip(order, [*order[1:], None])), "arc long, next long").repartition(3)
    for small in (1000, 10, 1):
        got = {r["arc"]: r["place"] for r in T.rank_list(arcs, Scratch(spark, "test"), small).collect()}
        assert got == {a: k for k, a in enumerate(order)}


def test_long_digest_is_that_of_the_joined_ids(spark):
    ids = [3 * k - 5000 for k in range(9000)]
    ends = spark.createDataFrame([("x", c) for c in ids] + [("y", 4)], "key string, conv long").repartition(5)
    got = {r["key"]: r["ends_sha256"] for r in T.digests(ends).collect()}
    assert got == {"x": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), "y": hashlib.sha256(b"4").hexdigest()}


def test_empty_tables(spark, tmp_path):
    for k, rows in enumerate(([], [(None, 1, "user", "x", "k", 7, 9)])):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/{k}/conversations.parquet")
        assert QUERIES["op12_prefix_trie"](spark, f"{tmp_path}/{k}").count() == 0
