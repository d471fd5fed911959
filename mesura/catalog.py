"""Registered queries: name -> (Spark callable, DuckDB oracle SQL).

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole of the driver's tables (through the materialised survey fact or the
tables themselves). The oracle SQL next to it computes the same result from
the raw tables in plain SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mesura.plans.analytics import dense_rank_of, pareto, q
from mesura.plans.evaluate import evaluate, rounded
from mesura.sources.survey import fact
from mesura.sqlfact import with_fact
from mesura.sqlmeasures import MPI, cnt, sdiv, sdiv0

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(x: str) -> str:
    return f"round({x}, 6)"


# ===========================================================================
# Flagship: persons, MPI persons and rate by municipality and year, dense rank
# within subregion and year, Pareto accumulation within year.
# ===========================================================================
FLAGSHIP_KEYS = ["anio", "Subregion", "Municipio"]


def mpi_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    agg = evaluate(fact(spark, sf_dir), FLAGSHIP_KEYS, ["persons", "mpi_persons", "mpi_rate"])
    cum, cum_pct = pareto(q("mpi_persons"), ["anio"])
    out = agg.withColumns({
        "mpi_rank": dense_rank_of(q("mpi_rate"), ["anio", "Subregion"]),
        "mpi_cumulative": cum,
        "mpi_cumulative_pct": cum_pct,
    })
    return rounded(out)


register("mpi_overview", with_fact(f"""
SELECT anio, Subregion, Municipio, persons, mpi_persons, {r6('mpi_rate')} AS mpi_rate,
  CAST(dense_rank() OVER (PARTITION BY anio, Subregion ORDER BY coalesce(mpi_rate, 0) DESC) AS BIGINT) AS mpi_rank,
  CAST(CASE WHEN mpi_persons IS NOT NULL THEN sum(mpi_persons) OVER (PARTITION BY anio ORDER BY mpi_persons DESC
       RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS BIGINT) AS mpi_cumulative,
  {r6(sdiv("CASE WHEN mpi_persons IS NOT NULL THEN sum(mpi_persons) OVER (PARTITION BY anio ORDER BY mpi_persons DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END",
           "sum(mpi_persons) OVER (PARTITION BY anio)"))} AS mpi_cumulative_pct
FROM (SELECT anio, Subregion, Municipio, {cnt()} AS persons, {cnt(MPI)} AS mpi_persons,
        {sdiv0(cnt(MPI), cnt())} AS mpi_rate
      FROM fact GROUP BY anio, Subregion, Municipio) t
"""))(mpi_overview)


# ===========================================================================
# Measure families M1-M5: one fused aggregate per query.
# ===========================================================================
from mesura.sqlmeasures import select_measures  # noqa: E402

FAMILIES: dict[str, tuple[list[str], list[str]]] = {
    # name: (group keys, measures)
    "grain_counts": (["anio", "Subregion"],
                     ["persons", "total_rows", "households", "dwellings", "distinct_classes",
                      "max_year", "min_age", "max_age"]),
    "group_counts": (["anio", "cod_mpio"],
                     ["persons_a", "persons_b", "persons_c", "persons_d", "group_a", "group_b",
                      "group_c", "group_d", "poverty_persons", "mpi_persons", "poor_households",
                      "men_negative", "women", "men_pyramid"]),
    "group_percentages": (["anio", "cod_mpio"],
                          ["pct_a", "pct_b", "pct_c", "pct_d", "poverty_rate", "mpi_rate",
                           "poverty_incidence", "incidence", "mpi_incidence_department", "pct_men",
                           "pct_women", "persons_per_household", "household_size"]),
    "service_gaps": (["anio", "Subregion"],
                     ["dwellings", "pct_no_energy", "pct_no_water_supply", "pct_no_sewer", "pct_no_gas",
                      "pct_no_waste_collection", "pct_with_energy", "pct_with_water_supply",
                      "pct_with_gas", "pct_no_water", "pct_poor_sanitation", "pct_crowded",
                      "pct_crowded_observed", "pct_rural_dwellings", "pct_multi_household_dwellings",
                      "dwellings_with_deprivation", "pct_dwellings_with_deprivation",
                      "dwellings_male_head", "dwellings_female_head", "pct_male_head",
                      "pct_female_head", "households_male_head", "households_female_head"]),
    "material_gaps": (["anio", "cod_mpio"], ["dwellings", "pct_poor_floors", "pct_poor_walls"]),
    "event_shares": (["anio", "Subregion"],
                     ["pct_flood", "pct_avalanche", "pct_earthquake", "pct_fire", "pct_windstorm",
                      "pct_subsidence"]),
    "asset_shares": (["anio", "cod_mpio"],
                     ["households", "pct_hh_internet", "pct_hh_fridge", "pct_hh_washer", "pct_hh_pc",
                      "pct_hh_motorbike", "pct_hh_tractor", "pct_hh_car", "pct_hh_property",
                      "pct_hh_kitchen", "pct_hh_water_7days", "pct_hh_water_24h", "pct_hh_solid_fuel",
                      "persons_per_bedroom"]),
    "expense_flags": (["anio", "cod_mpio"],
                      ["pct_hh_spend_food", "pct_hh_spend_transport", "pct_hh_spend_education",
                       "pct_hh_spend_health", "pct_hh_spend_utilities", "pct_hh_spend_phone",
                       "pct_hh_spend_rent", "pct_hh_spend_other"]),
    "indicator_rates": (["anio", "Subregion"], [f"pct_i{k}" for k in range(1, 16)]),
    "deprivation_means": (["anio", "Subregion"],
                          ["mean_housing_quality", "household_deprivation_score",
                           "mean_dwelling_deprivations", "mean_deprivations_rural",
                           "mean_deprivations_town", "mean_deprivations_male_head",
                           "mean_deprivations_female_head", "deprivation_gap", "mean_rooms",
                           "mean_households_per_dwelling", "mean_spend_total"]),
    "event_means": (["anio", "Subregion"],
                    ["mean_floods", "mean_avalanches", "mean_earthquakes", "mean_fires",
                     "mean_windstorms", "mean_subsidences"]),
    "quality_matrices": (["anio", "cod_mpio"],
                         ["persons", "validated", "valid_pct", "kpi_db_health", "integrity_pct",
                          "office_checks", "office_pct", "coordinator_checks", "coordinator_pct"]),
}


def _family(keys, names):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(evaluate(fact(spark, sf_dir), keys, names))
    return run


for _name, (_keys, _names) in FAMILIES.items():
    register(_name, with_fact(select_measures(_keys, _names)))(_family(_keys, _names))
