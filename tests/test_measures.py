"""Measure-layer rules on hand-made frames: filter replacement (B12),
context removal, dense ranks, Pareto, grain ordering."""

from pyspark.sql import functions as F

from mesura.plans.analytics import dense_rank_of, pareto, q, share_over
from mesura.plans.context import FilterContext
from mesura.plans.evaluate import evaluate

ROWS = [
    # Subregion, Municipio, grupo_sisben, H_5, tip_parentesco, ide_hogar, anio
    ("S1", "M1", "A", 1, 1, 1, 2000), ("S1", "M1", "A", 0, 2, 1, 2000), ("S1", "M1", "B", 1, 1, 2, 2000),
    ("S1", "M2", "B", 1, 1, 1, 2000), ("S1", "M2", "C", 0, 1, 1, 2001), ("S2", "M3", None, 1, 3, 1, 2000),
    ("S2", "M3", "A", 12, 1, 1, 2000),
]
SCHEMA = "Subregion string, Municipio string, grupo_sisben string, H_5 long, tip_parentesco long, ide_hogar long, anio long"


def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_filter_replacement(spark):
    out = {(r["Subregion"], r["grupo_sisben"]): r for r in
           evaluate(frame(spark), ["Subregion", "grupo_sisben"], ["persons", "persons_a"]).collect()}
    # the A count replaces the group filter: the same on every group row
    assert out[("S1", "B")]["persons_a"] == 2 and out[("S1", "C")]["persons_a"] == 2
    assert out[("S2", None)]["persons_a"] == 1
    assert out[("S1", "B")]["persons"] == 2


def test_filter_replacement_with_outer_filter(spark):
    ctx = FilterContext.of(grupo_sisben="B")
    r = evaluate(frame(spark), ["Subregion"], ["persons", "persons_a"], ctx).collect()
    # S2 has no person of group B, but the A count replaces that filter and shows it
    assert sorted((x["Subregion"], x["persons"], x["persons_a"]) for x in r) == [("S1", 2, 2), ("S2", None, 1)]


def test_mpi_prefix_and_blank(spark):
    r = {x["Municipio"]: x for x in evaluate(frame(spark), ["Municipio"], ["mpi_persons", "mpi_rate"]).collect()}
    assert r["M3"]["mpi_persons"] == 2           # "12" starts with "1"
    assert r["M2"]["mpi_persons"] == 1
    assert r["M1"]["mpi_rate"] == 2 / 3


def test_grains(spark):
    r = evaluate(frame(spark), [], ["persons", "households", "dwellings"]).collect()[0]
    assert r["persons"] >= r["households"] >= r["dwellings"]
    assert (r["persons"], r["households"], r["dwellings"]) == (7, 5, 4)


def test_shares_pareto_ranks(spark):
    agg = evaluate(frame(spark), ["Municipio"], ["mpi_persons"])
    cum, pct = pareto(q("mpi_persons"), [])
    out = agg.withColumns({"share": share_over(q("mpi_persons"), []), "cum": cum, "pct": pct,
                           "rk": dense_rank_of(q("mpi_persons"), [])}).orderBy(F.desc("mpi_persons")).collect()
    assert abs(sum(r["share"] for r in out) - 1) < 1e-12
    assert max(r["pct"] for r in out) == 1.0
    # peers share the cumulative value (RANGE frame) and the dense rank
    assert [r["mpi_persons"] for r in out] == [2, 2, 1]
    assert [r["cum"] for r in out] == [4, 4, 5]
    assert [r["rk"] for r in out] == [1, 1, 2]


def test_zero_code_matches_blank(spark):
    """Rule B4: the wall-code-0 dwelling count also counts a missing code."""
    from mesura.plans.measures import BASES
    df = spark.createDataFrame([(1, 1, 0), (1, 1, None), (1, 1, 3), (2, 1, None)],
                               "tip_parentesco long, ide_hogar long, tip_mat_paredes long")
    r = df.agg(BASES["DW_WALL_0"].make().alias("w0"), BASES["DW_WALL_3"].make().alias("w3"),
               BASES["DW_WALL_5"].make().alias("w5")).collect()[0]
    assert (r["w0"], r["w3"], r["w5"]) == (2, 1, None)


def test_pareto_blank_row_stays_blank(spark):
    df = spark.createDataFrame([("a", 3), ("b", None), ("c", 1)], "k string, v long")
    cum, pct = pareto(q("v"), [])
    out = {r["k"]: (r["cum"], r["pct"]) for r in df.withColumns({"cum": cum, "pct": pct}).collect()}
    assert out == {"a": (3, 0.75), "b": (None, None), "c": (4, 1.0)}
