import random

import pytest
from pyspark.sql import functions as F

from mesura.plans.prefix import Scratch, running
from mesura.session import path_exists


def brute(rows):
    out, total = [], {}
    for k, o, v in sorted(rows, key=lambda r: ((r[0] is not None, r[0] or 0), (r[1] is not None, r[1] or 0))):
        if v is not None or k in total:
            total[k] = (total.get(k) or 0) + (v or 0) if v is not None or total[k] is not None else None
        out.append((k, o, v, total.get(k)))
    return sorted(out, key=str)


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_sums_across_ranges(spark, keys):
    rng = random.Random(1)
    # one key holds most rows, so it lies in many ranges
    rows = [(1 if rng.random() < 0.7 else rng.randrange(40) if keys else 1, o, rng.choice([1, 2, 5])) for o in range(1500)] + [(None if keys else 1, None, 3), (77 if keys else 1, 5000, None)]
    if not keys:
        rows = [(1, o, v) for _, o, v in rows]
    df = spark.createDataFrame(rows, "k int, o int, v int").repartition(5)
    got = running(df, keys, ["o"], {"s": F.col("v")}, Scratch(spark, "test"))
    assert sorted((tuple(r) for r in got.select("k", "o", "v", "s").collect()), key=str) == brute(rows)


def test_descending_order_and_empty_table(spark):
    df = spark.createDataFrame([("a", k) for k in range(100)], "k string, o int")
    got = running(df, ["k"], [F.desc("o")], {"n": F.lit(1)}, Scratch(spark, "test"))
    assert {(r["o"], r["n"]) for r in got.collect()} == {(k, 100 - k) for k in range(100)}
    assert running(df.limit(0), [], ["o"], {"n": F.lit(1)}, Scratch(spark, "test")).count() == 0


def test_no_window_over_all_rows(spark):
    """The only window without keys is over one row a range."""
    df = spark.range(1000)
    got = running(df, [], ["id"], {"n": F.lit(1)}, Scratch(spark, "test"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("windowspecdefinition(0,") == plan.count("windowspecdefinition(0, __part") and "__part" in plan


def test_dropped_tables_are_gone(spark):
    scratch = Scratch(spark, "test")
    df = scratch.write(spark.range(3), "x")
    path = scratch.paths[id(df)]
    assert path_exists(spark, path) and df.count() == 3
    scratch.drop(df)
    assert not path_exists(spark, path)
