"""Measures under an outer context, selector choices, titles and the model's
relationships, on hand-made frames."""

import pytest
from pyspark.sql import functions as F

from mesura import schemas as S
from mesura.plans import choice, star
from mesura.plans.analytic import ANALYTIC, ask
from mesura.plans.context import FilterContext
from mesura.plans.evaluate import evaluate, q
from mesura.plans.title import title

ROWS = [("S1", "M1", "A", "1", 2000)] * 3 + [("S1", "M2", "B", "1", 2000)] * 1 + [("S2", "M3", "A", "1", 2000)] * 4 + [("S2", "M4", "B", "0", 2000)] * 2 + [("S1", "M1", "A", "0", 1999)] * 4
SCHEMA = "Subregion string, Municipio string, grupo_sisben string, H_5 string, anio long"


def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({"cod_mpio": q("Municipio"), "ind_evento_inundacion": F.lit(1).cast("long"), "num_evento_inundacion": F.lit(7).cast("long")})


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_shares_with_a_filter_on_a_removed_column(spark):
    ctx = FilterContext.of(Municipio="M1", anio=2000)
    got = ask(frame(spark), ["Municipio"], ["mpi_persons", "mpi_share", "mpi_share_in_subregion"], ctx)
    assert rows(got, "Municipio", "mpi_persons", "mpi_share") == [("M1", 3, 3 / 8)]
    got = ask(frame(spark), ["Subregion", "Municipio"], ["mpi_share_in_subregion"], ctx)
    assert rows(got, "Municipio", "mpi_share_in_subregion") == [("M1", 0.75)]
    # without that filter the window gives the same
    got = ask(frame(spark), ["Municipio"], ["mpi_share"], FilterContext.of(anio=2000))
    assert dict(rows(got, "Municipio", "mpi_share"))["M1"] == 3 / 8


def test_group_share_and_fixed_base(spark):
    got = ask(frame(spark), ["Subregion", "grupo_sisben"], ["pct_group"], FilterContext.of(grupo_sisben="A"))
    assert rows(got, "Subregion", "pct_group") == [("S1", 7 / 8), ("S2", 4 / 6)]


def test_ranks_and_accumulation_among_hidden_members(spark):
    got = ask(frame(spark), ["Municipio"], ["mpi_persons_rank", "mpi_cumulative", "mpi_cumulative_pct"], FilterContext.of(Municipio=["M1", "M4"], anio=2000))
    assert rows(got, "Municipio", "mpi_persons_rank", "mpi_cumulative", "mpi_cumulative_pct") == [("M1", 2, 7, 7 / 8), ("M4", 4, None, None)]


def test_picks_and_year_on_year(spark):
    got = ask(frame(spark), ["Subregion"], ["top_mpi_persons_municipality", "top_mpi_persons", "mpi_change"], FilterContext.of(anio=2000))
    assert rows(got, "Subregion", "top_mpi_persons_municipality", "top_mpi_persons", "mpi_change") == [("S1", "M1", 3, 1.0), ("S2", "M3", 4, 4 / 6)]
    with pytest.raises(ValueError, match="group by it"):
        ask(frame(spark), ["Subregion"], ["mpi_rank"])
    with pytest.raises(ValueError, match="do not group"):
        ask(frame(spark), ["Municipio"], ["top_mpi_persons"])


def test_every_analytic_measure_runs(spark):
    df = frame(spark).withColumns({c: F.lit(1).cast("long") for c in ("tip_parentesco", "ide_hogar")}).withColumn("estado", F.lit("0"))
    for name, spec in ANALYTIC.items():
        keys = ["Subregion", "Municipio"] if type(spec).__name__ in ("Rank", "Accumulated", "Share") else ["anio"] if spec.ref not in (24, 25, 26) else ["Subregion"]
        assert ask(df, keys, [name], FilterContext.of(anio=2000)).count() > 0, name


def test_table_filters_intersect_and_plain_filters_replace(spark):
    df = spark.createDataFrame([("S1", 1, 7), ("S1", 1, 9), ("S1", 2, 5)], "Subregion string, ind_evento_inundacion long, num_evento_inundacion long")
    got = evaluate(df, ["ind_evento_inundacion"], ["mean_floods", "selected_mean_floods"])
    assert rows(got, "ind_evento_inundacion", "mean_floods", "selected_mean_floods") == [(1, 8.0, 8.0), (2, None, 8.0)]
    got = evaluate(df, ["Subregion"], ["mean_floods", "selected_mean_floods"], FilterContext.of(ind_evento_inundacion=2))
    assert rows(got, "Subregion", "mean_floods", "selected_mean_floods") == [("S1", None, 8.0)]


def test_choices(spark):
    df = spark.createDataFrame([(1.0, 3.0, None)], "a double, b double, c double")
    branches = {k: q(k) for k in "abc"}
    got = df.select(choice.one(branches, ["a"]).alias("x"), choice.one(branches, ["a", "b"]).alias("y"), choice.one(branches, ["z"]).alias("z"), choice.mean(branches, ["a", "b"]).alias("m"),
                    choice.mean(branches, ["a", "c"]).alias("n"), choice.mean(branches, ["c"]).alias("o")).first()
    assert tuple(got) == (1.0, None, None, 2.0, 1.0, None)
    assert choice.indicator_title([]).endswith("Todas las categorías") and choice.indicator_title(["x", "y", "x"]).endswith(" – x, y")
    assert choice.household_title(["x", "x"]).endswith(" – x") and choice.household_title(["x", "y"]).endswith(" – Todas")
    assert choice.year_title([2000]) == "Año selecionado 2000" and choice.year_title([2000, 2001]) == "Año selecionado "


def test_titles(spark):
    df = frame(spark).withColumns({"Zona": F.lit("Rural"), "Clasificacion": F.lit("A1"), "Sexo_Jefe_Label": F.lit("Mujer jefe"), "Edad": F.lit(5).cast("long")})
    say = lambda **v: title(df, v).first()["title"]
    assert say() == S.TXT_OVERVIEW == "Visión General: Departamento de Antioquia"
    assert say(anio=[2000, 1999]) == "Selección de Filtros: Año 1999, 2000"
    assert say(Subregion=["S1"], Municipio=["M1", "M2"]) == "Selección de Filtros: En S1, M1, M2"
    assert say(Subregion=["S1", "S2"], grupo_sisben=["A"], Clasificacion=["A1"]) == "Selección de Filtros: Grupo A, A1"
    assert say(Sexo_Jefe_Label=["Mujer jefe"], Edad=[5, 9], Zona=["Rural"]) == "Selección de Filtros: Zona Rural • Mujer jefe Hogar • Edades 5 - 5"


def test_relationships(spark):
    fact = spark.createDataFrame([("01", 2000, "0"), ("01", 2001, "50"), ("02", 2000, None), ("09", 2000, "x")], "cod_mpio string, anio long, estado string")
    population = spark.createDataFrame([("01", 2000, "00-04", 5), ("02", 2000, "05-09", 7)], "cod_mpio string, anio long, Rango_Edad string, n long")
    dims = {"territory": spark.createDataFrame([("01", "X"), ("02", "Y")], "cod_mpio string, Subregion string"), "years": spark.createDataFrame([(2000,)], "anio long"),
            "state": spark.createDataFrame([(0, "Válido"), (50, "Verificación")], "Cod_Estado int, Categoria_Macro string"),
            "age_band": spark.createDataFrame([("00-04", 1), ("05-09", 2)], "Rango_Edad string, Orden int")}
    assert set(star.related("fact")) == {"territory", "state", "years"} and set(star.related("population")) == {"territory", "years", "age_band"}
    keep = {"territory": q("Subregion") == "X", "state": q("Categoria_Macro") == "Válido", "age_band": q("Orden") == 1}
    assert star.filtered(fact, "fact", dims, keep).count() == 1
    assert star.filtered(population, "population", dims, keep).count() == 1
    joined = star.with_dimension(fact, "fact", "state", dims["state"], ["Categoria_Macro"])
    assert rows(joined, "estado", "Categoria_Macro") == [("0", "Válido"), ("50", "Verificación"), ("x", None), (None, None)]
    with pytest.raises(KeyError):
        star.with_dimension(population, "population", "state", dims["state"], ["Categoria_Macro"])


def test_parameter_tables(spark):
    from mesura.sources.literals import parameter_tables
    tables = parameter_tables(spark)
    assert {k: t.count() for k, t in tables.items()} == {
        "state": len(S.STATE_ROWS), "mark": 4, "age_band": 17, "indicator": 15, "household_indicator": len(S.HOUSEHOLD_INDICATOR_ROWS),
        "housing_category": len(S.HOUSING_CATEGORY_ROWS), "housing_indicator": len(S.HOUSING_INDICATOR_ROWS), "housing_type": 3, "event": 6,
        "deprivation": 5, "sanitary_block": 4, "level": 2}
    assert {r["Tipo"] for r in tables["household_indicator"].collect()} == {"Condiciones", "Gasto"}
