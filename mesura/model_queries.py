"""Measures of any family under keys and an outer filter context, and selector
measures under a choice of labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mesura import schemas as S
from mesura.catalog import register
from mesura.plans import choice
from mesura.plans.analytic import ask
from mesura.plans.context import FilterContext
from mesura.plans.evaluate import evaluate, q, rounded
from mesura.sources.survey import fact
from mesura.sqlfact import lit, with_fact
from mesura.sqlmeasures import MPI, P, SQL, cnt, sdiv

CHOSEN = ["NATION_1", "NATION_7", "NATION_12"]
YEAR = 1996
_IN = ", ".join(map(lit, CHOSEN))


def shares_under_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares and ranks of three municipalities in one year: denominators and
    rivals are all municipalities, although the context shows three."""
    ctx = FilterContext.of(Municipio=CHOSEN, anio=YEAR)
    return rounded(ask(fact(spark, sf_dir), ["Subregion", "Municipio"], ["persons", "mpi_persons", "mpi_share", "mpi_share_in_subregion", "mpi_rank",
                                                                         "mpi_persons_rank", "mpi_cumulative", "mpi_cumulative_pct"], ctx))


register("shares_under_filter", with_fact(f"""
SELECT Subregion, Municipio, persons, mpi_persons, round({sdiv('mpi_persons', 'total')}, 6) AS mpi_share, round({sdiv('mpi_persons', 'subtotal')}, 6) AS mpi_share_in_subregion,
  mpi_rank, mpi_persons_rank, CAST(cumulative AS BIGINT) AS mpi_cumulative, round({sdiv('cumulative', 'total')}, 6) AS mpi_cumulative_pct
FROM (SELECT *, sum(mpi_persons) OVER () AS total, sum(mpi_persons) OVER (PARTITION BY Subregion) AS subtotal,
        CAST(dense_rank() OVER (PARTITION BY Subregion ORDER BY coalesce(rate, 0) DESC) AS BIGINT) AS mpi_rank,
        CAST(dense_rank() OVER (PARTITION BY Subregion ORDER BY coalesce(mpi_persons, 0) DESC) AS BIGINT) AS mpi_persons_rank,
        sum(mpi_persons) OVER (ORDER BY mpi_persons DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative
      FROM (SELECT Subregion, Municipio, {P} AS persons, {cnt(MPI)} AS mpi_persons, {SQL['mpi_rate']} AS rate FROM fact WHERE anio = {YEAR} GROUP BY 1, 2) a) b
WHERE Municipio IN ({_IN})
"""))(shares_under_filter)


def picks_under_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank-1 picks, year on year and shares of the groups by subregion, for
    persons of one area in the context of one year."""
    ctx = FilterContext.of(anio=YEAR, Zona="Rural")
    return rounded(ask(fact(spark, sf_dir), ["Subregion"], ["persons", "top_mpi_municipality", "top_mpi_persons", "top_mpi_share", "leader_share",
                                                            "mpi_rate_current_year", "mpi_rate_previous_year", "mpi_change", "mpi_share"], ctx))


register("picks_under_filter", with_fact(f"""
SELECT a.Subregion, a.persons, t.top_mpi_municipality, t.top_mpi_persons, round(t.top_share, 6) AS top_mpi_share, round(t.top_share, 6) AS leader_share,
  round(y.cur, 6) AS mpi_rate_current_year, round(y.prev, 6) AS mpi_rate_previous_year, round(y.cur - y.prev, 6) AS mpi_change,
  round({sdiv('a.mpi', 'sum(a.mpi) OVER ()')}, 6) AS mpi_share
FROM (SELECT Subregion, {P} AS persons, {cnt(MPI)} AS mpi FROM rural WHERE anio = {YEAR} GROUP BY 1) a
LEFT JOIN (SELECT Subregion, CASE WHEN count(*) FILTER (WHERE r = 1) = 1 THEN max(CASE WHEN r = 1 THEN Municipio END) END AS top_mpi_municipality,
    CAST(sum(CASE WHEN v = 1 THEN mpi END) AS BIGINT) AS top_mpi_persons, {sdiv('sum(CASE WHEN v = 1 THEN mpi END)', 'sum(mpi)')} AS top_share
  FROM (SELECT *, dense_rank() OVER (PARTITION BY Subregion ORDER BY coalesce(rate, 0) DESC) AS r, dense_rank() OVER (PARTITION BY Subregion ORDER BY coalesce(mpi, 0) DESC) AS v
        FROM (SELECT Subregion, Municipio, {cnt(MPI)} AS mpi, {SQL['mpi_rate']} AS rate FROM rural WHERE anio = {YEAR} GROUP BY 1, 2) m) n GROUP BY 1) t ON t.Subregion = a.Subregion
LEFT JOIN (SELECT Subregion, coalesce(sum(mpi) FILTER (WHERE anio = {YEAR}) / CAST(nullif(sum(p) FILTER (WHERE anio = {YEAR}), 0) AS DOUBLE), 0) AS cur,
    coalesce(sum(mpi) FILTER (WHERE anio = {YEAR} - 1) / CAST(nullif(sum(p) FILTER (WHERE anio = {YEAR} - 1), 0) AS DOUBLE), 0) AS prev
  FROM (SELECT Subregion, anio, {P} AS p, {cnt(MPI)} AS mpi FROM rural GROUP BY 1, 2) x GROUP BY 1) y ON y.Subregion = a.Subregion
""", "rural AS (SELECT * FROM fact WHERE Zona = 'Rural')"))(picks_under_filter)


def event_means_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of the event counts grouped by the event's own flag: the mean
    over filtered rows intersects (BLANK where the flag says no), the
    selector's mean replaces the flag (the same in every row)."""
    return rounded(evaluate(fact(spark, sf_dir), ["Subregion", "ind_evento_inundacion"], ["persons", "mean_floods", "selected_mean_floods"]))


register("event_means_by_flag", with_fact("""
SELECT a.Subregion, a.ind_evento_inundacion, a.persons, round(a.mean_floods, 6) AS mean_floods, round(b.m, 6) AS selected_mean_floods
FROM (SELECT Subregion, ind_evento_inundacion, count(*) AS persons, avg(num_evento_inundacion) FILTER (WHERE ind_evento_inundacion = 1) AS mean_floods FROM fact GROUP BY 1, 2) a
LEFT JOIN (SELECT Subregion, avg(num_evento_inundacion) AS m FROM fact WHERE ind_evento_inundacion = 1 GROUP BY 1) b ON a.Subregion = b.Subregion
"""))(event_means_by_flag)


def groups_under_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group counts under an outer filter on another group: each count
    replaces it, so a municipality without persons of group B is shown too."""
    ctx = FilterContext({"grupo_sisben": q("grupo_sisben") == "B", "Clasificacion": q("Clasificacion") == "B1"})
    return evaluate(fact(spark, sf_dir), ["anio", "NOM_BARRIO", "Municipio"], ["persons", "persons_a", "persons_b"], ctx)


register("groups_under_filter", with_fact("""
SELECT coalesce(m.anio, s.anio) AS anio, coalesce(m.NOM_BARRIO, s.NOM_BARRIO) AS NOM_BARRIO, coalesce(m.Municipio, s.Municipio) AS Municipio, m.persons, s.persons_a, s.persons_b
FROM (SELECT anio, NOM_BARRIO, Municipio, count(*) AS persons FROM fact WHERE grupo_sisben = 'B' AND Clasificacion = 'B1' GROUP BY 1, 2, 3) m
FULL OUTER JOIN (SELECT anio, NOM_BARRIO, Municipio, nullif(count(*) FILTER (WHERE grupo_sisben = 'A'), 0) AS persons_a, nullif(count(*) FILTER (WHERE grupo_sisben = 'B'), 0) AS persons_b
  FROM fact WHERE Clasificacion = 'B1' GROUP BY 1, 2, 3) s ON m.anio = s.anio AND m.NOM_BARRIO = s.NOM_BARRIO AND m.Municipio = s.Municipio
"""))(groups_under_filter)


def selector_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selector measures when one label, or several, are chosen."""
    services = dict(S.SERVICE_PROBLEMS)
    labels = [label for label, _ in S.INDICATOR_ROWS]
    indicators = {label: q(f"pct_i{k}") for k, label in enumerate(labels, start=1)}
    agg = evaluate(fact(spark, sf_dir), ["anio", "Subregion"], [*services.values(), "pct_i1", "pct_i2"])
    branches = {label: q(m) for label, m in services.items()}
    category = dict(S.INDICATOR_ROWS)
    return rounded(agg.select(
        "anio", "Subregion", choice.one(branches, ["Sin gas"]).alias("one_label"), choice.one(branches, ["Sin gas", "Sin energía"]).alias("several_labels"),
        choice.mean(indicators, labels[:2]).alias("mean_of_two"), F.lit(choice.indicator_title([])).alias("title_all"),
        F.lit(choice.indicator_title([category[labels[0]], category[labels[-1]]])).alias("title_two"), F.lit(choice.household_title(["a", "b"])).alias("household_all")))


_first, _last = S.INDICATOR_ROWS[0][1], S.INDICATOR_ROWS[-1][1]
register("selector_choices", with_fact(f"""
SELECT anio, Subregion, round(CAST(a AS DOUBLE), 6) AS one_label, CAST(NULL AS DOUBLE) AS several_labels, round((i1 + i2) / 2, 6) AS mean_of_two,
  {lit(S.TXT_MPI_HEATMAP + S.TXT_ALL_CATEGORIES)} AS title_all, {lit(S.TXT_MPI_HEATMAP + ", ".join(dict.fromkeys([_first, _last])))} AS title_two, {lit(S.TXT_HOUSEHOLD_HEATMAP + S.TXT_ALL)} AS household_all
FROM (SELECT anio, Subregion, {SQL['pct_no_gas']} AS a, {SQL['pct_i1']} AS i1, {SQL['pct_i2']} AS i2 FROM fact GROUP BY 1, 2) t
"""))(selector_choices)
