"""Queries over more than one table or grain: ranks and accumulation over all
households, CSV files of unlike headers read by name, coverage in a context,
totals of any measure at several grains, and row rules with the rows that
break them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mesura import schemas as S
from mesura.catalog import r6, register
from mesura.etl_queries import _POP_SQL, _dw_total, _hh_total, _long_sql, _pop, years_dim
from mesura.operators import quality, territory
from mesura.plans.context import FilterContext
from mesura.plans.coverage import Model, ask_model
from mesura.plans.evaluate import q, rounded
from mesura.plans.totals import evaluate_sets
from mesura.plans.prefix import Scratch, accumulated, dense_ranks
from mesura.session import ensure_checkpoint_dir, join_path, path_exists
from mesura.sources.files import read_csv_folder
from mesura.sources.survey import _fingerprint, fact
from mesura.sources.literals import age_band_dim, state_dim
from mesura.sqlfact import lit, with_fact
from mesura.sqlmeasures import SQL, cnt, sdiv, sdiv0


# ---------------------------------------------------------------- M8, M11, O3
def household_pareto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every household's spending: dense rank among all households of the year,
    and the spending of those not below it, as a sum and as a share."""
    scratch = Scratch(spark, "households")
    rows = fact(spark, sf_dir).groupBy("anio", "household_key").agg(
        F.count(F.lit(1)).alias("persons"), F.max(F.when(q("tip_parentesco") == 1, q("vlr_total_gastos"))).alias("spending"))
    rows = dense_ranks(scratch.write(rows, "rows"), ["anio"], "spending", "spending_rank", scratch)
    return rounded(accumulated(rows, ["anio"], "spending", "spending_cumulative", scratch))


_WITHIN = "sum(spending) OVER (PARTITION BY anio ORDER BY spending DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
register("household_pareto", with_fact(f"""
SELECT anio, household_key, persons, spending,
  CAST(dense_rank() OVER (PARTITION BY anio ORDER BY coalesce(spending, 0) DESC) AS BIGINT) AS spending_rank,
  CAST(CASE WHEN spending IS NOT NULL THEN {_WITHIN} END AS BIGINT) AS spending_cumulative,
  {r6(sdiv(f"CASE WHEN spending IS NOT NULL THEN {_WITHIN} END", "sum(spending) OVER (PARTITION BY anio)"))} AS spending_cumulative_pct
FROM (SELECT anio, household_key, count(*) AS persons, max(CASE WHEN tip_parentesco = 1 THEN vlr_total_gastos END) AS spending
      FROM fact GROUP BY 1, 2) t"""))(household_pareto)


# ---------------------------------------------------------------- S4
#: Columns of the written files, by year modulo 3: other orders, one column
#: less, one more, one in other case.
HEADERS = (("cod_mpio", "anio", "Edad", "estado"), ("Edad", "anio", "cod_mpio"), ("ANIO", "estado", "grupo_sisben", "Edad", "cod_mpio"))


def csv_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact's rows written as CSV files of three headers and read back:
    each file under its own header, the files united by name."""
    folder = join_path(ensure_checkpoint_dir(spark), "mesura_csv", _fingerprint(spark, sf_dir))
    for k, names in enumerate(HEADERS):
        part = join_path(folder, f"header{k}")
        if not path_exists(spark, join_path(part, "_SUCCESS")):
            rows = fact(spark, sf_dir).filter(q("anio") % 3 == k).select(*[q(n.lower() if n == "ANIO" else n).alias(n) for n in names])
            rows.write.mode("overwrite").option("header", True).option("sep", ";").csv(part)
    rows = read_csv_folder(spark, folder)
    return rows.groupBy(q("anio").cast("long").alias("anio"), "cod_mpio").agg(
        F.count(F.lit(1)).alias("records"), F.sum(q("Edad").cast("long")).alias("age_sum"), F.count("Edad").alias("ages"),
        F.count("estado").alias("states"), F.nullif(F.count_if(q("grupo_sisben") == "A"), F.lit(0)).alias("group_a"))


register("csv_by_name", with_fact(f"""
SELECT anio, cod_mpio, count(*) AS records, CAST(sum(Edad) AS BIGINT) AS age_sum, count(Edad) AS ages,
  count(CASE WHEN anio % 3 <> 1 THEN estado END) AS states, {cnt("anio % 3 = 2 AND grupo_sisben = 'A'")} AS group_a
FROM fact GROUP BY 1, 2"""))(csv_by_name)


# ---------------------------------------------------------------- M12, J6, J7
def survey_model(spark: SparkSession, sf_dir: str, **filters) -> Model:
    f = fact(spark, sf_dir)
    return Model(f, {"population": _pop(spark, sf_dir), "households": _hh_total(spark, sf_dir), "dwellings": _dw_total(spark, sf_dir)},
                 {"territory": territory.territory_dim(spark, sf_dir), "years": years_dim(f), "age_band": age_band_dim(spark), "state": state_dim(spark)}, filters)


COVERED = ["persons", "coverage_rate", "household_coverage", "population_coverage", "dwelling_coverage"]


def coverage_in_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four coverage measures by year and municipality of three subregions
    up to 1998, for the valid states and the age bands of adults: the year and
    subregion reach both sides, the state the fact, the age band the
    population."""
    model = survey_model(spark, sf_dir, state=q("Categoria_Macro") == "Válido", age_band=q("Orden") >= 5)
    ctx = FilterContext({"anio": q("anio") <= 1998, "Subregion": q("Subregion").isin("AFRICA", "ASIA", "EUROPE")})
    return rounded(ask_model(model, ["anio", "Subregion", "Municipio"], COVERED, ctx))


def coverage_by_subregion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same measures by subregion alone, the years filtered on their
    dimension: ``coverage_rate`` takes the latest year's population."""
    model = survey_model(spark, sf_dir, years=q("anio") <= 1998)
    return rounded(ask_model(model, ["Subregion"], COVERED))


_TERRITORY = "JOIN nation n ON p.cod_mpio = lpad(CAST(n.n_nationkey AS VARCHAR), 5, '0') JOIN region r ON n.n_regionkey = r.r_regionkey"
_REGIONS = "('AFRICA', 'ASIA', 'EUROPE')"
_VALID = ", ".join(str(c) for c, _, m in S.STATE_ROWS if m == "Válido")
_ADULT = ", ".join(lit(t) for _, t in S.AGE_BANDS[4:])
_SOURCES = (f"pop AS ({_POP_SQL})", f"hh AS ({_long_sql('Hogares_Proyectados', 'count(*)')})",
            f"dw AS ({_long_sql('Viviendas_Proyectadas', 'count(DISTINCT ck)')})")


def _projected(name: str, table: str, value: str, keys: str, where: str) -> str:
    return f"{name} AS (SELECT {keys}, sum(p.{value}) AS v FROM {table} p {_TERRITORY} WHERE {where} GROUP BY ALL)"


def _covered(f: str, population: str, latest: str) -> str:
    return (f"f.persons, round({sdiv('f.persons', latest)}, 6) AS coverage_rate, round({sdiv0('f.households', 'h.v')}, 6) AS household_coverage, "
            f"round({sdiv0('f.persons', population)}, 6) AS population_coverage, round({sdiv0('f.dwellings', 'd.v')}, 6) AS dwelling_coverage")


_SIDE = f"{SQL['persons']} AS persons, {SQL['households']} AS households, {SQL['dwellings']} AS dwellings, max(anio) AS latest"
_CELL = "p.anio AS y, n.n_name AS m"
register("coverage_in_context", with_fact(
    f"""SELECT f.anio, f.Subregion, f.Municipio, {_covered('f', 'pp.v', 'pp.v')}
FROM side f LEFT JOIN pp ON pp.y = f.anio AND pp.m = f.Municipio LEFT JOIN h ON h.y = f.anio AND h.m = f.Municipio LEFT JOIN d ON d.y = f.anio AND d.m = f.Municipio""",
    *_SOURCES,
    f"side AS (SELECT anio, Subregion, Municipio, {_SIDE} FROM fact WHERE anio <= 1998 AND Subregion IN {_REGIONS} AND TRY_CAST(estado AS INTEGER) IN ({_VALID}) GROUP BY 1, 2, 3)",
    _projected("pp", "pop", "Poblacion_Proyectada", _CELL, f"r.r_name IN {_REGIONS} AND p.Rango_Edad IN ({_ADULT})"),
    _projected("h", "hh", "Hogares_Proyectados", _CELL, "p.Cod_clase = 0"), _projected("d", "dw", "Viviendas_Proyectadas", _CELL, "p.Cod_clase = 0")))(coverage_in_context)
register("coverage_by_subregion", with_fact(
    f"""SELECT f.Subregion, {_covered('f', 'pp.v', 'pl.v')}
FROM side f LEFT JOIN pp ON pp.s = f.Subregion LEFT JOIN pl ON pl.s = f.Subregion AND pl.y = f.latest LEFT JOIN h ON h.s = f.Subregion LEFT JOIN d ON d.s = f.Subregion""",
    *_SOURCES,
    f"side AS (SELECT Subregion, {_SIDE} FROM fact WHERE anio <= 1998 GROUP BY 1)",
    "yrs AS (SELECT DISTINCT anio FROM fact WHERE anio <= 1998)",
    _projected("pp", "pop", "Poblacion_Proyectada", "r.r_name AS s", "p.anio IN (SELECT anio FROM yrs)"),
    _projected("pl", "pop", "Poblacion_Proyectada", "r.r_name AS s, p.anio AS y", "true"),
    _projected("h", "hh", "Hogares_Proyectados", "r.r_name AS s", "p.Cod_clase = 0 AND p.anio IN (SELECT anio FROM yrs)"),
    _projected("d", "dw", "Viviendas_Proyectadas", "r.r_name AS s", "p.Cod_clase = 0 AND p.anio IN (SELECT anio FROM yrs)")))(coverage_by_subregion)


# ---------------------------------------------------------------- totals of any measure
SETS = [["anio", "Subregion", "grupo_sisben"], ["anio", "Subregion"], ["Subregion", "grupo_sisben"], []]
SET_KEYS = ["anio", "Subregion", "grupo_sisben"]
SET_MEASURES = ["persons", "households", "distinct_classes", "max_year", "mpi_rate", "household_size", "mean_rooms", "deprivation_gap", "pct_i3", "group_a", "pct_a"]


def totals_by_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, ratios, means and distinct counts at four grains, for the groups
    A to C. Measures with a filter on the group of their own replace that of
    the context and of the key."""
    return rounded(evaluate_sets(fact(spark, sf_dir), SETS, SET_MEASURES, FilterContext.of(grupo_sisben=["A", "B", "C"])))


def _set_sql(keys: list[str]) -> str:
    """One of the four sets: its rows, and those of the replaced filter."""
    rest = [k for k in keys if k != "grupo_sisben"]
    side = ", ".join([*rest, f"{SQL['group_a']} AS group_a"])
    own = ", ".join([*keys, *[f"{SQL[m]} AS {m}" for m in SET_MEASURES if m not in ("group_a", "pct_a")]])
    by = lambda c: f" GROUP BY {', '.join(c)}" if c else ""
    on = " AND ".join([f"m.{k} IS NOT DISTINCT FROM s.{k}" for k in rest] or ["true"])
    marks = ", ".join(f"{'m.' + k if k in keys else 'NULL'} AS {k}, {str(k not in keys).lower()} AS {k}_total" for k in SET_KEYS)
    values = ", ".join(f"round(m.{m}, 6) AS {m}" if m in ("mpi_rate", "household_size", "mean_rooms", "deprivation_gap", "pct_i3") else f"m.{m}"
                       for m in SET_MEASURES if m not in ("group_a", "pct_a"))
    return (f"SELECT {marks}, {values}, s.group_a, round({sdiv('s.group_a', 'm.persons')}, 6) AS pct_a "
            f"FROM (SELECT {own} FROM fact WHERE grupo_sisben IN ('A', 'B', 'C'){by(keys)}) m LEFT JOIN (SELECT {side} FROM fact{by(rest)}) s ON {on}")


register("totals_by_sets", with_fact("\nUNION ALL\n".join(map(_set_sql, SETS))))(totals_by_sets)


# ---------------------------------------------------------------- row rules
def _rules_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_known_keys(fact(spark, sf_dir), spark, territory.territory_dim(spark, sf_dir))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows checked and broken for each of fifteen row rules and year."""
    return quality.rule_counts(_rules_rows(spark, sf_dir), quality.survey_rules(), ["anio"])


def quality_broken_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written table of rows that break a rule, counted by what they break."""
    rows = quality.broken_rows(_rules_rows(spark, sf_dir), quality.survey_rules(), ["anio", "cod_mpio", "household_key"])
    written = Scratch(spark, "quality").write(rows, "broken")
    return written.groupBy("anio", F.array_join("broken_rules", ",").alias("broken_rules")).agg(F.count(F.lit(1)).alias("records"))


#: The rules once more, in SQL: name, kind, broken.
_RULES_SQL = (
    ("age_missing", "missing", "Edad IS NULL"), ("group_missing", "missing", "grupo_sisben IS NULL"), ("state_missing", "missing", "estado IS NULL"),
    ("age_out_of_range", "range", "Edad NOT BETWEEN 0 AND 97"), ("spending_negative", "range", "vlr_total_gastos < 0"),
    ("rooms_out_of_range", "range", "num_cuartos_vivienda NOT BETWEEN 1 AND 20"), ("sex_code", "code", "sexo_persona NOT IN (1, 2)"),
    ("area_code", "code", "Cod_clase NOT IN (1, 2, 3)"), ("state_not_numeric", "code", "estado IS NOT NULL AND TRY_CAST(estado AS INTEGER) IS NULL"),
    ("head_under_age", "cross", "tip_parentesco = 1 AND Edad < 15"), ("more_bedrooms_than_rooms", "cross", "num_cuartos_dormir > num_cuartos_vivienda"),
    ("more_events_than_flagged", "cross", "ind_evento_inundacion = 2 AND num_evento_inundacion > 0"),
    ("group_against_class", "cross", "grupo_sisben <> substring(Clasificacion, 1, 1)"),
    ("state_unknown", "key", f"estado IS NOT NULL AND coalesce(TRY_CAST(estado AS INTEGER) NOT IN ({', '.join(str(c) for c, _, _ in S.STATE_ROWS)}), true)"),
    ("municipality_unknown", "key", "cod_mpio NOT IN (SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') FROM nation)"),
)
register("quality_rules", with_fact("\nUNION ALL\n".join(
    f"SELECT anio, '{name}' AS rule, '{kind}' AS kind, count({x}) AS checked, count(*) FILTER (WHERE {x}) AS broken FROM fact GROUP BY 1"
    for name, kind, x in _RULES_SQL)))(quality_rules)
register("quality_broken_rows", with_fact(
    "SELECT anio, broken_rules, count(*) AS records FROM (SELECT anio, concat_ws(',', " + ", ".join(f"CASE WHEN {x} THEN '{name}' END" for name, _, x in _RULES_SQL) +
    ") AS broken_rules FROM fact) t WHERE broken_rules <> '' GROUP BY 1, 2"))(quality_broken_rows)
