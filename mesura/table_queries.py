"""Queries over tables that are kept: facts from footers, distinct counts from
bitmaps, the yearly table of bases, and an export rewritten in part."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mesura.catalog import register
from mesura.operators import export, territory
from mesura.plans.context import FilterContext
from mesura.plans.distinct import distinct_by_sets
from mesura.plans.evaluate import q, rounded
from mesura.plans.prefix import Scratch
from mesura.plans.yearly import YearlyBases
from mesura.session import ensure_checkpoint_dir, join_path
from mesura.sources.footers import number_facts, row_groups
from mesura.sources.survey import VIEW_FROM_SQL, fact, materialise_fact, survey_rows
from mesura.sqlfact import lit, with_fact
from mesura.sqlmeasures import SQL

# ---------------------------------------------------------------- S3
#: Number columns of the source tables.
NUMBERS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey", "n_regionkey"], "customer": ["c_custkey", "c_nationkey", "c_acctbal"],
    "supplier": ["s_suppkey", "s_nationkey", "s_acctbal"], "part": ["p_partkey", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_totalprice"], "events": ["event_id", "user_id", "value"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"],
}


def footer_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, nulls and bounds of every number column of the source tables,
    merged from the footers of all row groups; no page is read."""
    groups = row_groups(spark, {t: f"{sf_dir.rstrip('/')}/{t}.parquet" for t in NUMBERS})
    return number_facts(groups)


register("footer_facts", "\nUNION ALL\n".join(
    f"SELECT {lit(t)} AS table_name, {lit(c)} AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, "
    f"CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high FROM {t}" for t, cs in NUMBERS.items() for c in cs))(footer_facts)


# ---------------------------------------------------------------- B7
DISTINCT_SETS = [["anio", "Subregion", "grupo"], ["anio", "Subregion"], ["Subregion", "grupo"], []]
DISTINCT_KEYS = ["anio", "Subregion", "grupo"]


def distinct_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct households, their customers and dwellings' parts at four grains,
    from bitmaps of the finest: a household's persons are in several groups,
    a customer's households in several years."""
    rows = survey_rows(spark, sf_dir).select(F.year("o_orderdate").cast("long").alias("anio"), F.col("r_name").alias("Subregion"),
                                             F.substring(F.lit("ABCD"), (F.col("l_partkey") % 4 + 1).cast("int"), 1).alias("grupo"),
                                             "l_orderkey", "o_custkey", "l_partkey")
    ids = {"households": q("l_orderkey"), "customers": q("o_custkey"), "parts": q("l_partkey")}
    return distinct_by_sets(rows, DISTINCT_SETS, ids, Scratch(spark, "distinct"))


def _distinct_sql(keys: list[str]) -> str:
    shown = ", ".join(f"{k if k in keys else 'NULL'} AS {k}, {str(k not in keys).lower()} AS {k}_total" for k in DISTINCT_KEYS)
    by = f" GROUP BY {', '.join(keys)}" if keys else ""
    return f"SELECT {shown}, count(DISTINCT l_orderkey) AS households, count(DISTINCT o_custkey) AS customers, count(DISTINCT l_partkey) AS parts FROM rows{by}"


register("distinct_ids", f"""WITH rows AS (SELECT CAST(year(o_orderdate) AS BIGINT) AS anio, r_name AS Subregion,
  substring('ABCD', CAST(l_partkey % 4 + 1 AS INTEGER), 1) AS grupo, l_orderkey, o_custkey, l_partkey FROM {VIEW_FROM_SQL})
""" + "\nUNION ALL\n".join(map(_distinct_sql, DISTINCT_SETS)))(distinct_ids)


# ---------------------------------------------------------------- yearly accumulation
YEARLY_MEASURES = ["persons", "households", "dwellings", "mpi_persons", "mpi_rate", "pct_a", "poverty_rate", "pct_no_energy", "pct_poor_floors",
                   "pct_flood", "pct_hh_internet", "pct_hh_spend_food", "pct_i3", "persons_per_bedroom", "max_year", "max_age", "valid_pct"]


def yearly_bases(spark: SparkSession, sf_dir: str) -> YearlyBases:
    """The kept table of bases of the fact of ``sf_dir``."""
    path = materialise_fact(spark, sf_dir)
    return YearlyBases(spark, path, fact(spark, sf_dir).schema, path.replace("/mesura_fact/", "/mesura_yearly/"))


def accumulated_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of M1 to M5 by year and subregion, three years left out,
    from the yearly table of bases (years whose files changed are rebuilt)."""
    bases = yearly_bases(spark, sf_dir)
    bases.refresh()
    return rounded(bases.evaluate(["anio", "Subregion"], YEARLY_MEASURES, FilterContext({"anio": q("anio") >= 1998})))


register("accumulated_measures", with_fact(
    "SELECT anio, Subregion, " + ", ".join(f"round({SQL[m]}, 6) AS {m}" if m.startswith("pct") or m.endswith(("rate", "pct", "bedroom")) else f"{SQL[m]} AS {m}"
                                           for m in YEARLY_MEASURES) + " FROM fact WHERE anio >= 1998 GROUP BY 1, 2"))(accumulated_measures)


# ---------------------------------------------------------------- S8
REWRITTEN = ["00003", "00007"]
EXPORTED = ["cod_mpio", "anio", "household_key", "Edad", "grupo_sisben"]


def export_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest year exported by municipality; then two municipalities again,
    household heads alone. Read back through the manifest."""
    out = join_path(ensure_checkpoint_dir(spark), "mesura_export", f"rewritten-{uuid.uuid4().hex}")
    f = fact(spark, sf_dir)
    rows = FilterContext.latest(f).apply(f)
    known = {r[0]: r[1] for r in territory.territory_dim(spark, sf_dir).select("cod_mpio", "Municipio").collect()}  # a row a municipality
    own = rows.select(*EXPORTED)
    export.write_extract(spark, own, known, out)
    export.write_extract(spark, rows.filter(q("cod_mpio").isin(*REWRITTEN) & (q("tip_parentesco") == 1)).select(*EXPORTED), known, out)
    return export.read_extract(spark, out, own.schema).groupBy("cod_mpio", "anio").agg(
        F.count(F.lit(1)).alias("persons"), F.sum("Edad").alias("age_sum"), F.count("grupo_sisben").alias("grouped"), F.sum("household_key").alias("key_sum"))


register("export_rewritten", with_fact(f"""
SELECT cod_mpio, anio, count(*) AS persons, CAST(sum(Edad) AS BIGINT) AS age_sum, count(grupo_sisben) AS grouped, CAST(sum(household_key) AS BIGINT) AS key_sum
FROM fact WHERE anio = (SELECT max(anio) FROM fact) AND (cod_mpio NOT IN ('{REWRITTEN[0]}', '{REWRITTEN[1]}') OR tip_parentesco = 1) GROUP BY 1, 2"""))(export_rewritten)
