"""ETL, projection, coverage, quality and export queries."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mesura import schemas as S
from mesura.catalog import register
from mesura.functions.blank import div, div0
from mesura.functions.labels import lenient_long, norm_code, null_text
from mesura.operators import clean, export, projections, quality, territory
from mesura.plans import star
from mesura.plans.evaluate import evaluate, rounded
from mesura.plans.title import title
from mesura.session import ensure_checkpoint_dir, join_path
from mesura.sources.literals import age_band_dim, state_dim
from mesura.sources.survey import SURVEY_COLUMNS, _fingerprint, fact
from mesura.sources.tables import read_table
from mesura.sqlfact import age_band_sql, lit, with_fact
from mesura.sqlmeasures import DW, HH, P, SQL, cnt, sdiv, sdiv0


def q(name: str):
    return F.col(f"`{name}`")


# ---------------------------------------------------------------- P6-P8
def _raw_text():
    return (F.when(q("l_linenumber") % 7 == 0, q("l_quantity").cast("string"))
             .when(q("l_linenumber") % 7 == 1, F.lit("nan"))
             .when(q("l_linenumber") % 7 == 2, F.lit("x"))
             .when(q("l_linenumber") % 7 == 3, q("l_discount").cast("string"))
             .when(q("l_linenumber") % 7 == 4, q("l_partkey").cast("string"))
             .when(q("l_linenumber") % 7 == 6, F.concat(q("l_suppkey").cast("string"), F.lit(".0"))))


def _raw_code():
    s = q("l_suppkey").cast("string")
    return (F.when(q("l_linenumber") % 4 == 0, s)
             .when(q("l_linenumber") % 4 == 1, F.concat(s, F.lit(".0")))
             .when(q("l_linenumber") % 4 == 2, F.lpad(s, 5, "0")))


def clean_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lenient integer parse, "nan" text to null and 5-digit codes, over the
    whole lineitem table (raw text built from its columns)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", _raw_text().alias("raw_value"), _raw_code().alias("raw_code"),
        F.when(q("l_linenumber") % 3 == 0, F.lit("nan")).otherwise(q("l_returnflag")).alias("raw_text"))
    return li.select("l_orderkey", "l_linenumber", "raw_value",
                     lenient_long(q("raw_value")).alias("value_long"),
                     null_text(q("raw_text")).alias("text_clean"),
                     "raw_code", norm_code(q("raw_code")).alias("code_clean"))


register("clean_codes", """
WITH s AS (SELECT l_orderkey, l_linenumber,
  CASE l_linenumber % 7 WHEN 0 THEN CAST(l_quantity AS VARCHAR) WHEN 1 THEN 'nan' WHEN 2 THEN 'x'
    WHEN 3 THEN CAST(l_discount AS VARCHAR) WHEN 4 THEN CAST(l_partkey AS VARCHAR)
    WHEN 6 THEN CAST(l_suppkey AS VARCHAR) || '.0' END AS raw_value,
  CASE l_linenumber % 4 WHEN 0 THEN CAST(l_suppkey AS VARCHAR) WHEN 1 THEN CAST(l_suppkey AS VARCHAR) || '.0'
    WHEN 2 THEN lpad(CAST(l_suppkey AS VARCHAR), 5, '0') END AS raw_code,
  CASE WHEN l_linenumber % 3 = 0 THEN 'nan' ELSE l_returnflag END AS raw_text
  FROM lineitem),
t AS (SELECT *, TRY_CAST(raw_value AS DECIMAL(38,10)) AS d, regexp_replace(raw_code, '\\.0$', '') AS c FROM s)
SELECT l_orderkey, l_linenumber, raw_value,
  CASE WHEN d % 1 = 0 THEN TRY_CAST(d AS BIGINT) END AS value_long,
  CASE WHEN raw_text = 'nan' THEN NULL ELSE raw_text END AS text_clean,
  raw_code,
  CASE WHEN (CASE WHEN length(c) < 5 THEN lpad(c, 5, '0') ELSE c END) IN ('00nan', '000na', 'nan') THEN NULL
       ELSE (CASE WHEN length(c) < 5 THEN lpad(c, 5, '0') ELSE c END) END AS code_clean
FROM t
""")(clean_codes)


# ---------------------------------------------------------------- D1-D24
LABELS = [("tip_vivienda", "Tipo_Vivienda_txt"), ("tip_mat_paredes", "Material de las Paredes"),
          ("ind_tiene_energia", "Energia_txt"), ("ind_tiene_acueducto", "Acueducto_txt"),
          ("ind_tiene_alcantarillado", "Alcantarillado_txt"), ("ind_tiene_gas", "Gas_txt"),
          ("ind_tiene_recoleccion", "Recoleccion_txt"), ("Cod_clase", "Clase_txt"),
          ("tip_sanitario", "Sanitario_txt"), ("Cod_clase", "Zona"), ("tip_mat_pisos", "Material del Piso"),
          ("tip_ocupa_vivienda", "Tipo_Ocupacion_txt"), ("tip_seg_social", "Regimen_Salud_Limpio")]


def label_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (code, label) pair of the 13 label columns with its row count:
    one scan, the pairs stacked before one aggregate."""
    triples = [x for c, lab in LABELS for x in (F.lit(lab), q(c).cast("long"), q(lab))]
    rows = fact(spark, sf_dir).select(F.stack(F.lit(len(LABELS)), *triples).alias("column_name", "code", "label"))
    return rows.groupBy("column_name", "code", "label").agg(F.count(F.lit(1)).alias("records"))


register("label_columns", with_fact(" UNION ALL ".join(
    f"SELECT '{lab}' AS column_name, {c} AS code, \"{lab}\" AS label, count(*) AS records FROM fact GROUP BY 2, 3"
    for c, lab in LABELS)))(label_columns)


def _grouped(cols: list[str], aliases: dict[str, str] | None = None):
    aliases = aliases or {}

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        f = fact(spark, sf_dir)
        return f.groupBy(*[q(c).alias(aliases.get(c, c)) for c in cols]).agg(F.count(F.lit(1)).alias("records"))
    return run


def _grouped_sql(cols: list[str], aliases: dict[str, str] | None = None) -> str:
    aliases = aliases or {}
    sel = ", ".join(f'"{c}" AS "{aliases.get(c, c)}"' for c in cols)
    return with_fact(f"SELECT {sel}, count(*) AS records FROM fact GROUP BY ALL")


for _name, _cols in [
    ("order_class", ["Clasificacion", "orden_clasificacion"]),
    ("deprivation_level", ["I11", "I12", "I13", "I14", "I15", "Privaciones_Vivienda", "Nivel_Calidad_Vivienda"]),
    ("crowding", ["num_personas_hogar", "num_cuartos_vivienda", "Personas_por_Cuarto", "Cat_Hacinamiento"]),
    ("head_flags", ["tip_parentesco", "sexo_persona", "Es_Jefe", "Sexo_Jefe", "Sexo_Jefe_Label"]),
    ("age_band", ["Edad", "Rango_Edad", "Orden_Edad"]),
]:
    register(_name, _grouped_sql(_cols))(_grouped(_cols))


# ---------------------------------------------------------------- P1-P4
DAMAGED = {"ind_discap_bañarse": "IND_DISCAP_BA?ARSE", "tip_cuidado_niños": "tip_cuidado_niÃ±os",
           "Num_evento_vendaval": "NUM_EVENTO_VENDAVAL"}
REPAIRED_ORDER = ["cod_mpio", "anio", "ind_discap_bañarse", "tip_cuidado_niños", "num_evento_vendaval",
                  "Source.Name", "filename"]


def header_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged headers repaired by pattern (P1), the windstorm count renamed
    and ``filename`` added (P3), columns put in the target order (P4)."""
    f = fact(spark, sf_dir).withColumnsRenamed(DAMAGED)
    return clean.reorder(clean.reinforce(clean.repair_headers(f)), REPAIRED_ORDER)


register("header_repair", with_fact(
    'SELECT cod_mpio, anio, "ind_discap_bañarse", "tip_cuidado_niños", "Num_evento_vendaval" AS num_evento_vendaval, '
    '"Source.Name", "Source.Name" AS filename FROM fact'))(header_repair)


# ---------------------------------------------------------------- P13, P14, J1
def territory_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Territory dimension joined to the fact's persons per code; codes
    without rows keep a null count, fact codes without a dimension row keep
    null attributes (full outer, one row per code)."""
    dim = territory.territory_dim(spark, sf_dir)
    per = fact(spark, sf_dir).groupBy("cod_mpio").agg(F.count(F.lit(1)).alias("persons"))
    return dim.join(per, "cod_mpio", "full_outer")


register("territory_dim", """
SELECT coalesce(d.cod_mpio, f.cod_mpio) AS cod_mpio, d.Municipio, d.Subregion, d.Cod_SubRegion, f.persons
FROM (SELECT lpad(CAST(n.n_nationkey AS VARCHAR), 5, '0') AS cod_mpio, n.n_name AS Municipio, r.r_name AS Subregion,
             lpad(CAST(n.n_regionkey AS VARCHAR), 2, '0') AS Cod_SubRegion
      FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
      QUALIFY row_number() OVER (PARTITION BY n.n_nationkey ORDER BY n.n_name) = 1) d
FULL OUTER JOIN (SELECT lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') AS cod_mpio, count(*) AS persons
                 FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                 JOIN customer c ON o.o_custkey = c.c_custkey
                 JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
                 GROUP BY 1) f ON d.cod_mpio = f.cod_mpio
""")(territory_persons)


# ---------------------------------------------------------------- P5, P10, J3, D29
def latest_year_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.latest_year_extract(fact(spark, sf_dir), territory.territory_dim(spark, sf_dir))


def _extract_columns() -> list[str]:
    names = [n for n, _, _ in SURVEY_COLUMNS if n not in export.EXCLUDE]
    first = [c for c in S.EXTRACT_PRIORITY if c != "NOM_MUNICIPIO"]
    return first + [n for n in names if n not in first]


register("latest_year_extract", with_fact(
    "SELECT cod_mpio, cod_mpio || ' - ' || coalesce(t.n_name, 'Sin nombre') AS NOM_MUNICIPIO, " +
    ", ".join(f'f."{c}"' for c in _extract_columns() if c != "cod_mpio") +
    " FROM fact f LEFT JOIN nation t ON f.cod_mpio = lpad(CAST(t.n_nationkey AS VARCHAR), 5, '0')"
    " WHERE f.anio = (SELECT max(anio) FROM fact)"))(latest_year_extract)


# ---------------------------------------------------------------- projections
#: What the derived projection tables stand for: years of their sheets, and
#: years and department that the coverage queries ask for.
SHEET_YEARS = list(range(1993, 2018))
COVERAGE_YEARS = list(range(1996, 2002))
DEPARTMENT = "05"


def wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Household projections, sheet shape -> (cod_mpio, anio, Cod_clase, value)."""
    return projections.wide_to_long(projections.projection_wide(spark, sf_dir, "households", SHEET_YEARS),
                                    "Hogares_Proyectados", DEPARTMENT, COVERAGE_YEARS)


def _long_sql(value: str, measure: str) -> str:
    years = COVERAGE_YEARS
    return f"""
WITH j AS (SELECT c.c_nationkey AS nk, n.n_regionkey AS rk, year(o.o_orderdate) AS yr,
                  CASE WHEN o.o_orderkey % 2 = 0 THEN 1 ELSE 2 END AS cls, o.o_custkey AS ck
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT lpad(CAST(nk AS VARCHAR), 5, '0') AS cod_mpio, CAST(yr AS BIGINT) AS anio, CAST(cls AS BIGINT) AS Cod_clase,
       CAST({measure} AS BIGINT) AS {value}
FROM j WHERE rk % 2 = 0 AND yr BETWEEN {years[0]} AND {years[-1]} GROUP BY nk, yr, cls
UNION ALL
SELECT lpad(CAST(nk AS VARCHAR), 5, '0'), CAST(yr AS BIGINT), CAST(0 AS BIGINT), CAST({measure} AS BIGINT)
FROM j WHERE rk % 2 = 0 AND yr BETWEEN {years[0]} AND {years[-1]} GROUP BY nk, yr
"""


register("wide_to_long", _long_sql("Hogares_Proyectados", "count(*)"))(wide_to_long)


def wide_to_long_dwellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.wide_to_long(projections.projection_wide(spark, sf_dir, "dwellings", SHEET_YEARS),
                                    "Viviendas_Proyectadas", DEPARTMENT, COVERAGE_YEARS)


register("wide_to_long_dwellings", _long_sql("Viviendas_Proyectadas", "count(DISTINCT ck)"))(wide_to_long_dwellings)


def population_by_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.population_by_band(projections.population_raw(spark, sf_dir), COVERAGE_YEARS)


_POP_SQL = f"""
SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS cod_mpio, CAST(1995 + c_custkey % 7 AS BIGINT) AS anio,
  CAST(CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 3 END AS BIGINT) AS Cod_clase,
  CAST(CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 2 END AS BIGINT) AS sexo_persona,
  CASE WHEN c_custkey % 53 = 0 OR c_custkey % 59 = 0 THEN {lit(S.UNKNOWN)}
       ELSE {age_band_sql('(c_custkey % 97)')} END AS Rango_Edad,
  CAST(sum(50 + c_custkey % 7) AS BIGINT) AS Poblacion_Proyectada
FROM customer WHERE 1995 + c_custkey % 7 BETWEEN {COVERAGE_YEARS[0]} AND {COVERAGE_YEARS[-1]}
GROUP BY ALL
"""
register("population_by_band", _POP_SQL)(population_by_band)


# ---------------------------------------------------------------- M12, J6, J7
def _coverage(survey_measure: str, proj: DataFrame, proj_col: str, out: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        keys = ["cod_mpio", "anio"]
        s = evaluate(fact(spark, sf_dir), keys, [survey_measure])
        pr = proj(spark, sf_dir).groupBy(*keys).agg(F.sum(proj_col).alias("projected"))
        j = s.join(pr, keys, "full_outer")
        res = j.select(*keys, survey_measure, "projected", q("projected").isNotNull().alias("has_projection"),
                       div0(q(survey_measure), q("projected")).alias(out),
                       div(q(survey_measure), q("projected")).alias(out + "_blank"))
        return rounded(res)
    return run


def _pop(spark, sf_dir):
    return population_by_band(spark, sf_dir)


def _hh_total(spark, sf_dir):
    return wide_to_long(spark, sf_dir).where(q("Cod_clase") == 0)


def _dw_total(spark, sf_dir):
    return wide_to_long_dwellings(spark, sf_dir).where(q("Cod_clase") == 0)


def _coverage_sql(survey_measure: str, proj_sql: str, proj_col: str, out: str, proj_where: str = "") -> str:
    return with_fact(f"""
SELECT coalesce(s.cod_mpio, p.cod_mpio) AS cod_mpio, coalesce(s.anio, p.anio) AS anio, s.{survey_measure},
  p.projected, p.projected IS NOT NULL AS has_projection, round({sdiv0(f's.{survey_measure}', 'p.projected')}, 6) AS {out},
  round({sdiv(f's.{survey_measure}', 'p.projected')}, 6) AS {out}_blank
FROM (SELECT cod_mpio, anio, {SQL[survey_measure]} AS {survey_measure} FROM fact GROUP BY 1, 2) s
FULL OUTER JOIN (SELECT cod_mpio, anio, CAST(sum({proj_col}) AS BIGINT) AS projected FROM proj {proj_where} GROUP BY 1, 2) p
  ON s.cod_mpio = p.cod_mpio AND s.anio = p.anio
""", f"proj AS ({proj_sql})")


register("coverage_population", _coverage_sql("persons", _POP_SQL, "Poblacion_Proyectada", "population_coverage"))(
    _coverage("persons", _pop, "Poblacion_Proyectada", "population_coverage"))
register("coverage_households", _coverage_sql("households", _long_sql("Hogares_Proyectados", "count(*)"),
                                              "Hogares_Proyectados", "household_coverage", "WHERE Cod_clase = 0"))(
    _coverage("households", _hh_total, "Hogares_Proyectados", "household_coverage"))
register("coverage_dwellings", _coverage_sql("dwellings", _long_sql("Viviendas_Proyectadas", "count(DISTINCT ck)"),
                                             "Viviendas_Proyectadas", "dwelling_coverage", "WHERE Cod_clase = 0"))(
    _coverage("dwellings", _dw_total, "Viviendas_Proyectadas", "dwelling_coverage"))


def coverage_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage with the year carried over to the projections.

    ``coverage_latest``: persons and population both of the latest year of the
    year table. ``coverage_rate``: all persons in context over the population
    of the latest year that the municipality has persons of.
    """
    f, pop = fact(spark, sf_dir), _pop(spark, sf_dir)
    latest = years_dim(f).agg(F.max("anio")).scalar()
    per = f.groupBy("cod_mpio").agg(F.nullif(F.count(F.lit(1)), F.lit(0)).alias("persons"), F.max("anio").alias("current_year"),
                                    F.nullif(F.count_if(q("anio") == latest), F.lit(0)).alias("persons_latest"))
    by_year = pop.groupBy("cod_mpio", "anio").agg(F.sum("Poblacion_Proyectada").alias("population"))
    at_latest = by_year.where(q("anio") == latest).select("cod_mpio", q("population").alias("population_latest"))
    own_year = by_year.select(q("cod_mpio").alias("__m"), q("anio").alias("__y"), q("population").alias("population_current"))
    j = (per.join(at_latest, "cod_mpio", "full_outer")
            .join(own_year, (q("cod_mpio") == q("__m")) & (q("current_year") == q("__y")), "left"))
    return rounded(j.select("cod_mpio", "current_year", "persons", "persons_latest", "population_latest", "population_current",
                            div(q("persons_latest"), q("population_latest")).alias("coverage_latest"),
                            div(q("persons"), q("population_current")).alias("coverage_rate")))


def years_dim(f: DataFrame) -> DataFrame:
    """A4: the year table, the distinct years of the fact."""
    return f.select("anio").distinct()


register("coverage_latest", with_fact(f"""
SELECT coalesce(s.cod_mpio, p.cod_mpio) AS cod_mpio, s.current_year, s.persons, s.persons_latest, p.population_latest, c.population AS population_current,
  round({sdiv('s.persons_latest', 'p.population_latest')}, 6) AS coverage_latest, round({sdiv('s.persons', 'c.population')}, 6) AS coverage_rate
FROM (SELECT cod_mpio, max(anio) AS current_year, {P} AS persons, {cnt('anio = (SELECT max(anio) FROM fact)')} AS persons_latest FROM fact GROUP BY 1) s
FULL OUTER JOIN (SELECT cod_mpio, population AS population_latest FROM by_year WHERE anio = (SELECT max(anio) FROM fact)) p ON s.cod_mpio = p.cod_mpio
LEFT JOIN by_year c ON c.cod_mpio = s.cod_mpio AND c.anio = s.current_year
""", f"proj AS ({_POP_SQL})", "by_year AS (SELECT cod_mpio, anio, CAST(sum(Poblacion_Proyectada) AS BIGINT) AS population FROM proj GROUP BY 1, 2)"))(coverage_latest)

register("years_dim", with_fact("SELECT DISTINCT anio FROM fact"))(lambda spark, sf_dir: years_dim(fact(spark, sf_dir)))


def filter_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension filters that reach fact and projections through the model's
    relationships: one subregion, the age bands of adults, the valid states.
    The state reaches the fact alone, the age band the population alone."""
    dims = {"territory": territory.territory_dim(spark, sf_dir), "age_band": age_band_dim(spark), "state": state_dim(spark)}
    keep = {"territory": q("Subregion") == "EUROPE", "age_band": q("Orden") >= 5, "state": q("Categoria_Macro") == "Válido"}
    f = star.filtered(fact(spark, sf_dir), "fact", dims, keep)
    pop = star.filtered(_pop(spark, sf_dir), "population", dims, keep)
    persons = f.groupBy("cod_mpio").agg(F.count(F.lit(1)).alias("persons"))
    people = pop.groupBy("cod_mpio").agg(F.sum("Poblacion_Proyectada").alias("population"))
    both = persons.join(people, "cod_mpio", "full_outer")
    return star.with_dimension(both, "fact", "territory", dims["territory"], ["Municipio"])


register("filter_propagation", with_fact(f"""
SELECT coalesce(a.cod_mpio, b.cod_mpio) AS cod_mpio, a.persons, b.population, t.n_name AS Municipio
FROM (SELECT f.cod_mpio, count(*) AS persons FROM fact f
      JOIN nation n ON f.cod_mpio = lpad(CAST(n.n_nationkey AS VARCHAR), 5, '0') JOIN region r ON n.n_regionkey = r.r_regionkey
      WHERE r.r_name = 'EUROPE' AND TRY_CAST(f.estado AS INTEGER) IN ({", ".join(str(c) for c, _, m in S.STATE_ROWS if m == "Válido")}) GROUP BY 1) a
FULL OUTER JOIN (SELECT p.cod_mpio, CAST(sum(p.Poblacion_Proyectada) AS BIGINT) AS population FROM proj p
      JOIN nation n ON p.cod_mpio = lpad(CAST(n.n_nationkey AS VARCHAR), 5, '0') JOIN region r ON n.n_regionkey = r.r_regionkey
      WHERE r.r_name = 'EUROPE' AND p.Rango_Edad IN ({", ".join(lit(t) for _, t in S.AGE_BANDS[4:])}) GROUP BY 1) b ON a.cod_mpio = b.cod_mpio
LEFT JOIN nation t ON coalesce(a.cod_mpio, b.cod_mpio) = lpad(CAST(t.n_nationkey AS VARCHAR), 5, '0')
""", f"proj AS ({_POP_SQL})"))(filter_propagation)


# ---------------------------------------------------------------- A2, Q1, Q2
def state_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.crosstab(fact(spark, sf_dir), "anio", "estado")


register("state_by_year", with_fact("SELECT anio, estado, count(*) AS records FROM fact GROUP BY ALL"))(state_by_year)


def mark_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide form: one column per mark code of the mark dimension, and one for
    any other mark and none."""
    codes = [str(c) for c, _ in S.MARK_ROWS]
    return quality.crosstab_wide(fact(spark, sf_dir), "anio", "marca", codes)


register("mark_by_year", with_fact(
    "SELECT anio, " + ", ".join(f"nullif(count(*) FILTER (WHERE marca = '{c}'), 0) AS \"{c}\""
                                for c, _ in S.MARK_ROWS) +
    ", nullif(count(*) FILTER (WHERE coalesce(marca, '') NOT IN (" + ", ".join(f"'{c}'" for c, _ in S.MARK_ROWS) + ")), 0) AS other FROM fact GROUP BY anio"))(mark_by_year)


def quality_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_categories(fact(spark, sf_dir), spark, ["anio"])


_STATE_VALUES = ", ".join(f"({c}, {lit(m)})" for c, _, m in S.STATE_ROWS)
register("quality_categories", with_fact(f"""
SELECT anio, count(*) AS persons,
  {cnt("cat = 'Válido'")} AS persons_valid, {cnt("cat = 'Verificación'")} AS persons_to_verify,
  {cnt("cat = 'Excluido'")} AS persons_excluded, {cnt("cat IS NULL")} AS persons_unknown_state
FROM (SELECT f.anio, s.cat FROM fact f LEFT JOIN (VALUES {_STATE_VALUES}) s(code, cat)
      ON TRY_CAST(f.estado AS INTEGER) = s.code) t GROUP BY anio
"""))(quality_categories)


#: Columns that the survey view is built from, as its declaration spells them.
SOURCE_COLUMNS = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"],
    "orders": ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"],
    "customer": ["c_custkey", "c_nationkey"],
}


def schema_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared columns of the source tables against the schemas read from
    them (Q1), with each table's row count (S3)."""
    parts = []
    for table, expected in SOURCE_COLUMNS.items():
        path = f"{sf_dir.rstrip('/')}/{table}.parquet"
        rows = F.lit(spark.read.parquet(path).count()).cast("long")
        parts.append(quality.schema_conformance(spark, expected, path).select(F.lit(table).alias("table_name"), "expected", "actual", "status", rows.alias("row_count")))
    return reduce(DataFrame.unionByName, parts)


def _conformance_sql(table: str, expected: list[str]) -> str:
    names = ", ".join(f"({lit(c)})" for c in expected)
    return f"""SELECT {lit(table)} AS table_name, e.name AS expected, a.column_name AS actual,
  CASE WHEN e.name IS NULL THEN 'extra' WHEN a.column_name IS NULL THEN 'missing' WHEN e.name = a.column_name THEN 'ok' ELSE 'case' END AS status,
  (SELECT count(*) FROM {table}) AS row_count
FROM (VALUES {names}) e(name) FULL OUTER JOIN (SELECT column_name FROM (DESCRIBE {table})) a ON lower(e.name) = lower(a.column_name)"""


register("schema_conformance", " UNION ALL ".join(_conformance_sql(t, c) for t, c in SOURCE_COLUMNS.items()))(schema_conformance)


# ---------------------------------------------------------------- J4
def normalised_name_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Territory names matched to resource names written in another case
    and spacing (as file names are), through the normalised key."""
    dim = territory.territory_dim(spark, sf_dir).select("cod_mpio", q("Municipio").alias("nom_mpio"))
    files = (fact(spark, sf_dir).select("Municipio").distinct()
             .select(F.concat(F.lit(" "), F.upper(F.regexp_replace("Municipio", "_", " _")), F.lit(" "))
                     .alias("file_name")))
    return territory.normalised_name_join(dim, files, spark)


register("normalised_name_join", f"""
WITH dim AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS cod_mpio, n_name AS nom_mpio FROM nation),
files AS (SELECT DISTINCT ' ' || upper(replace(n.n_name, '_', ' _')) || ' ' AS file_name
          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
          JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
al(dim_norm, file_norm) AS (VALUES {", ".join(f"({lit(a)}, {lit(b)})" for a, b in S.NAME_ALIASES)}),
dk AS (SELECT d.*, coalesce(al.file_norm, k) AS k FROM
        (SELECT *, coalesce(replace(trim(lower(strip_accents(nom_mpio))), ' ', ''), '') AS k FROM dim) d
        LEFT JOIN al ON d.k = al.dim_norm),
fk AS (SELECT replace(trim(lower(strip_accents(file_name))), ' ', '') AS fk, min(file_name) AS matched_file
       FROM files GROUP BY 1)
SELECT cod_mpio, nom_mpio, coalesce(matched_file, '') AS matched_file FROM dk LEFT JOIN fk ON dk.k = fk.fk
""")(normalised_name_join)


# ---------------------------------------------------------------- S8-S10
def export_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the latest-year extract as files of one municipality each to the
    shared folder, and returns the download catalogue of those files."""
    out = join_path(ensure_checkpoint_dir(spark), "mesura_export", _fingerprint(spark, sf_dir), uuid.uuid4().hex)
    return export.export_municipalities(spark, fact(spark, sf_dir), territory.territory_dim(spark, sf_dir), out)


_FILE_PART = "upper(replace(replace(strip_accents(n.n_name), ' ', '_'), '/', '_'))"
register("export_catalogue", with_fact(f"""
SELECT f.cod_mpio, replace({_FILE_PART}, '_', ' ') AS nom_mpio,
  'mpio_' || f.cod_mpio || '_' || {_FILE_PART} || '_ultimo_anio.csv?download=1' AS Url_Descarga,
  'informe_' || f.cod_mpio || '_' || {_FILE_PART} || '.pdf?download=1' AS Url_Informe,
  '' AS Url_Descarga_Variables, f.cod_mpio || '.png?raw=true' AS Bandera_escudo
FROM (SELECT DISTINCT cod_mpio FROM fact WHERE anio = (SELECT max(anio) FROM fact)) f
JOIN nation n ON f.cod_mpio = lpad(CAST(n.n_nationkey AS VARCHAR), 5, '0')
"""))(export_catalogue)


# ---------------------------------------------------------------- title (173)
TITLE_CONTEXTS = {
    "all": {},
    "one year and subregion": {"anio": [1995], "Subregion": ["ASIA"]},
    "several": {"Subregion": ["ASIA", "EUROPE"], "Zona": ["Rural"], "grupo_sisben": ["A", "B"],
                "Clasificacion": ["A1", "A2", "A3", "B1", "B2", "B3"], "Sexo_Jefe_Label": ["Mujer jefe"], "Edad": list(range(18, 65))},
}


def dashboard_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The title under three filter contexts."""
    f = fact(spark, sf_dir)
    return reduce(DataFrame.unionByName, [title(f, values).select(F.lit(name).alias("context"), "title") for name, values in TITLE_CONTEXTS.items()])


register("dashboard_title", with_fact(f"""
SELECT 'all' AS context, {lit(S.TXT_OVERVIEW)} AS title
UNION ALL SELECT 'one year and subregion', {lit(S.TXT_SELECTION)} || 'Año ' || string_agg(DISTINCT anio, ', ') || ' • En ' || max(Subregion)
  FROM fact WHERE anio = 1995 AND Subregion = 'ASIA'
UNION ALL SELECT 'several', {lit(S.TXT_SELECTION)} || 'Zona ' || max(Zona) || ' • Grupo ' ||
    array_to_string(list_sort(list(DISTINCT grupo_sisben)), ', ') || ', ' || array_to_string(list_sort(list(DISTINCT Clasificacion)), ', ') || ' • ' ||
    max(Sexo_Jefe_Label) || ' Hogar • Edades ' || min(Edad) || ' - ' || max(Edad)
  FROM fact WHERE Subregion IN ('ASIA', 'EUROPE') AND Zona = 'Rural' AND grupo_sisben IN ('A', 'B')
    AND Clasificacion IN ('A1', 'A2', 'A3', 'B1', 'B2', 'B3') AND Sexo_Jefe_Label = 'Mujer jefe' AND Edad BETWEEN 18 AND 64
"""))(dashboard_title)


# ---------------------------------------------------------------- totals, pyramid
def totals_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals re-evaluated at coarser keys (ROLLUP), ratios after aggregation."""
    f = fact(spark, sf_dir)
    from mesura.plans.measures import BASES
    agg = f.rollup("Subregion", "Municipio").agg(
        F.grouping_id().cast("long").alias("level"),
        *[BASES[b].make().alias(b) for b in ("P", "HH", "DW", "PIPM")])
    return rounded(agg.select("level", "Subregion", "Municipio", q("P").alias("persons"),
                              q("HH").alias("households"), q("DW").alias("dwellings"),
                              q("PIPM").alias("mpi_persons"), div0(q("PIPM"), q("P")).alias("mpi_rate")))


register("totals_by_level", with_fact(f"""
SELECT CAST(GROUPING(Subregion, Municipio) AS BIGINT) AS level, Subregion, Municipio, {P} AS persons,
  {cnt(HH)} AS households, {cnt(DW)} AS dwellings, {SQL['mpi_persons']} AS mpi_persons,
  round({SQL['mpi_rate']}, 6) AS mpi_rate
FROM fact GROUP BY ROLLUP (Subregion, Municipio)
"""))(totals_by_level)


def sex_age_pyramid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed counts by age band, with the band order of the age dimension."""
    agg = evaluate(fact(spark, sf_dir), ["Rango_Edad"], ["men_negative", "women", "men_pyramid"])
    dim = age_band_dim(spark)
    return (agg.join(dim, "Rango_Edad", "left").select("Rango_Edad", q("Orden").cast("long").alias("Orden"),
                                                       "men_negative", "women", "men_pyramid").orderBy("Orden"))


register("sex_age_pyramid", with_fact(f"""
SELECT Rango_Edad, CAST(min(Orden_Edad) AS BIGINT) AS Orden, {SQL['men_negative']} AS men_negative,
  {SQL['women']} AS women, {SQL['men_pyramid']} AS men_pyramid
FROM fact GROUP BY Rango_Edad
"""))(sex_age_pyramid)
