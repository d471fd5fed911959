"""Queries whose measures change the filter context.

Pattern: aggregate the fact once at the finest keys the measures need, then
compute shares, ranks, rank-1 picks, year-on-year and Pareto with windows
over that small aggregate. Where a denominator drops a filter that the outer
context sets (ALLEXCEPT over years, for instance) the fact is aggregated a
second time without it and joined back on the remaining keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mesura import schemas as S
from mesura.catalog import register
from mesura.functions.blank import blank_sub, div, div0, pct1
from mesura.operators.territory import territory_dim
from mesura.plans.analytics import dense_rank_of, pareto, q, share_over, total_over
from mesura.plans.context import FilterContext
from mesura.plans.evaluate import evaluate, join_on_keys, rounded
from mesura.plans.measures import BASES, DWELL_COLS as GRAIN, EXPENSES
from mesura.sources.survey import fact
from mesura.sqlfact import lit, with_fact
from mesura.sqlmeasures import DW, MPI, P, SQL, bsub, cnt, sdiv, sdiv0

TERRITORY = set(S.TERRITORY_COLUMNS)


# ---------------------------------------------------------------- M6
def expense_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean over the household numbers within the dwelling of the per-number
    maximum expense (AVERAGEX over VALUES(ide_hogar) of MAX)."""
    keys = ["anio", "Subregion"]
    cols = {f"mean_spend_{k}": f"vlr_gasto_{v}" for k, v in EXPENSES.items()}
    lvl1 = (fact(spark, sf_dir).groupBy(*keys, "ide_hogar")
            .agg(*[F.max(c).alias(n) for n, c in cols.items()]))
    out = lvl1.groupBy(*keys).agg(*[F.avg(n).alias(n) for n in cols])
    return rounded(out)


_exp_cols = {f"mean_spend_{k}": f"vlr_gasto_{v}" for k, v in EXPENSES.items()}
register("expense_means", with_fact(
    "SELECT anio, Subregion, " + ", ".join(f"round(avg({n}), 6) AS {n}" for n in _exp_cols) +
    " FROM (SELECT anio, Subregion, ide_hogar, " +
    ", ".join(f"max({c}) AS {n}" for n, c in _exp_cols.items()) +
    " FROM fact GROUP BY anio, Subregion, ide_hogar) t GROUP BY anio, Subregion"))(expense_means)


# ---------------------------------------------------------------- M7
def share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares with territory filters removed: the denominators are window sums
    over the aggregate partitioned by the non-territory keys."""
    keys = ["anio", "cod_mpio"]
    agg = evaluate(fact(spark, sf_dir), keys, ["persons", "mpi_persons"])
    rest = [k for k in keys if k not in TERRITORY]
    out = agg.withColumns({
        "mpi_share": share_over(q("mpi_persons"), rest),
        "pct_persons_municipality": share_over(q("persons"), [k for k in keys if k != "cod_mpio"]),
        "pct_mpi_persons_municipality": share_over(q("mpi_persons"), [k for k in keys if k != "cod_mpio"]),
    }).withColumn("municipality_share", q("pct_persons_municipality"))
    return rounded(out)


register("share_of_total", with_fact(f"""
SELECT anio, cod_mpio, persons, mpi_persons,
  round(CAST(mpi_persons AS DOUBLE) / nullif(sum(mpi_persons) OVER (PARTITION BY anio), 0), 6) AS mpi_share,
  round(CAST(persons AS DOUBLE) / nullif(sum(persons) OVER (PARTITION BY anio), 0), 6) AS pct_persons_municipality,
  round(CAST(mpi_persons AS DOUBLE) / nullif(sum(mpi_persons) OVER (PARTITION BY anio), 0), 6) AS pct_mpi_persons_municipality,
  round(CAST(persons AS DOUBLE) / nullif(sum(persons) OVER (PARTITION BY anio), 0), 6) AS municipality_share
FROM (SELECT anio, cod_mpio, {P} AS persons, {cnt(MPI)} AS mpi_persons FROM fact GROUP BY anio, cod_mpio) t
"""))(share_of_total)


def share_in_subregion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares inside the subregion, with and without the group filter, and
    the group share. ``persons_a`` shows filter replacement: grouped by
    grupo_sisben it is the same A count on every group row."""
    keys = ["anio", "Subregion", "Municipio", "grupo_sisben"]
    agg = evaluate(fact(spark, sf_dir), keys, ["persons", "mpi_persons", "persons_a"])
    out = agg.withColumns({
        "mpi_share_in_subregion": share_over(q("mpi_persons"), ["anio", "Subregion", "grupo_sisben"]),
        "mpi_share_in_subregion_all_groups": share_over(q("mpi_persons"), ["anio", "Subregion"]),
        "mpi_share_in_subregion_selection": share_over(q("mpi_persons"), ["anio", "Subregion"]),
        "pct_group": share_over(q("persons"), ["anio", "Subregion", "Municipio"]),
    })
    return rounded(out)


def _sh(v, part):
    return f"round(CAST({v} AS DOUBLE) / nullif(sum({v}) OVER (PARTITION BY {part}), 0), 6)"


register("share_in_subregion", with_fact(f"""
SELECT t.anio, t.Subregion, t.Municipio, t.grupo_sisben, persons, mpi_persons, a.persons_a,
  {_sh('mpi_persons', 't.anio, t.Subregion, t.grupo_sisben')} AS mpi_share_in_subregion,
  {_sh('mpi_persons', 't.anio, t.Subregion')} AS mpi_share_in_subregion_all_groups,
  {_sh('mpi_persons', 't.anio, t.Subregion')} AS mpi_share_in_subregion_selection,
  {_sh('persons', 't.anio, t.Subregion, t.Municipio')} AS pct_group
FROM (SELECT anio, Subregion, Municipio, grupo_sisben, {P} AS persons, {cnt(MPI)} AS mpi_persons
      FROM fact GROUP BY 1, 2, 3, 4) t
LEFT JOIN (SELECT anio, Subregion, Municipio, {cnt("grupo_sisben = 'A'")} AS persons_a
           FROM fact GROUP BY 1, 2, 3) a
  ON t.anio = a.anio AND t.Subregion = a.Subregion AND t.Municipio = a.Municipio
"""))(share_in_subregion)


def share_fixed_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wall and floor material shares of dwellings in the latest year over the
    subregion's dwellings of *all* years (ALLEXCEPT keeps only the subregion
    filter): the denominator is a second aggregate joined on Subregion."""
    f = fact(spark, sf_dir)
    base = evaluate(f, ["Subregion"], ["dwellings"]).withColumnRenamed("dwellings", "subregion_dwellings")
    kinds = [("wall", "tip_mat_paredes"), ("floor", "tip_mat_pisos")]
    # both materials of a row, stacked before one aggregate
    both = F.stack(F.lit(2), *[x for kind, c in kinds for x in (F.lit(kind), q(c))]).alias("material_kind", "material_code")
    now = FilterContext.latest(f).apply(f)
    num = now.select("Subregion", *GRAIN, both).groupBy("Subregion", "material_kind", "material_code").agg(BASES["DW"].make().alias("dwellings"))
    return rounded(join_on_keys(num, base, ["Subregion"]).select(
        "Subregion", "material_kind", "material_code", "dwellings", div(q("dwellings"), q("subregion_dwellings")).alias("material_share")))


register("share_fixed_base", with_fact(f"""
SELECT n.Subregion, n.material_kind, n.material_code, n.dwellings,
       round(CAST(n.dwellings AS DOUBLE) / nullif(b.subregion_dwellings, 0), 6) AS material_share
FROM (SELECT Subregion, 'wall' AS material_kind, tip_mat_paredes AS material_code, {cnt(DW)} AS dwellings
      FROM fact WHERE anio = (SELECT max(anio) FROM fact) GROUP BY 1, 2, 3
      UNION ALL
      SELECT Subregion, 'floor', tip_mat_pisos, {cnt(DW)}
      FROM fact WHERE anio = (SELECT max(anio) FROM fact) GROUP BY 1, 2, 3) n
LEFT JOIN (SELECT Subregion, {cnt(DW)} AS subregion_dwellings FROM fact GROUP BY Subregion) b
  ON n.Subregion = b.Subregion
"""))(share_fixed_base)


def share_of_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ALLSELECTED: total persons of the user's selection (latest year) on
    every row, and the group labels built from it."""
    f = fact(spark, sf_dir)
    agg = evaluate(f, ["Subregion"], ["persons", "group_a", "group_b", "group_c", "group_d"], FilterContext.latest(f))
    out = agg.withColumn("persons_in_selection", total_over(q("persons"), []))
    labels = {}
    for g in "abcd":
        labels[f"label_group_{g}"] = F.concat(
            F.format_number(q(f"group_{g}"), 0), F.lit(" ("),
            pct1(div(q(f"group_{g}"), q("persons_in_selection"))), F.lit(")"))
    return rounded(out.withColumns(labels))


def _fmt0(x):
    return f"format('{{:,.0f}}', CAST({x} AS DOUBLE))"


def _pct1(x):
    return f"(format('{{:,.1f}}', 100 * ({x})) || '%')"


register("share_of_selection", with_fact(f"""
SELECT Subregion, persons, group_a, group_b, group_c, group_d, CAST(persons_in_selection AS BIGINT) AS persons_in_selection,
  {", ".join(f"{_fmt0('group_' + g)} || ' (' || {_pct1(f'CAST(group_{g} AS DOUBLE) / nullif(persons_in_selection, 0)')} || ')' AS label_group_{g}" for g in 'abcd')}
FROM (SELECT *, sum(persons) OVER () AS persons_in_selection FROM (
  SELECT Subregion, {P} AS persons, {", ".join(f"{cnt(f'grupo_sisben = {chr(39)}{g.upper()}{chr(39)}')} AS group_{g}" for g in 'abcd')}
  FROM fact WHERE anio = (SELECT max(anio) FROM fact) GROUP BY Subregion) s) t
"""))(share_of_selection)


# ---------------------------------------------------------------- M8
def rank_incidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    agg = evaluate(fact(spark, sf_dir), ["anio", "Municipio"], ["mpi_rate"])
    return rounded(agg.withColumn("mpi_rank", dense_rank_of(q("mpi_rate"), ["anio"])))


register("rank_incidence", with_fact(f"""
SELECT anio, Municipio, round(mpi_rate, 6) AS mpi_rate,
  CAST(dense_rank() OVER (PARTITION BY anio ORDER BY coalesce(mpi_rate, 0) DESC) AS BIGINT) AS mpi_rank
FROM (SELECT anio, Municipio, {SQL['mpi_rate']} AS mpi_rate FROM fact GROUP BY 1, 2) t
"""))(rank_incidence)


def rank_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    agg = evaluate(fact(spark, sf_dir), ["anio", "Municipio"], ["mpi_persons"])
    r = dense_rank_of(q("mpi_persons"), ["anio"])
    return agg.withColumns({"mpi_persons_rank": r, "volume_rank": r})


register("rank_volume", with_fact(f"""
SELECT anio, Municipio, mpi_persons,
  CAST(dense_rank() OVER (PARTITION BY anio ORDER BY coalesce(mpi_persons, 0) DESC) AS BIGINT) AS mpi_persons_rank,
  CAST(dense_rank() OVER (PARTITION BY anio ORDER BY coalesce(mpi_persons, 0) DESC) AS BIGINT) AS volume_rank
FROM (SELECT anio, Municipio, {cnt(MPI)} AS mpi_persons FROM fact GROUP BY 1, 2) t
"""))(rank_volume)


def rank_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality-matrix ranks: BLANK measure -> BLANK rank, others ranked with
    BLANK counted as 0."""
    agg = evaluate(fact(spark, sf_dir), ["anio", "Municipio"], ["valid_pct", "office_pct", "coordinator_pct"])
    cols = {}
    for m, r in [("valid_pct", "valid_rank"), ("office_pct", "office_rank"),
                 ("coordinator_pct", "coordinator_rank")]:
        cols[r] = F.when(q(m).isNotNull(), dense_rank_of(q(m), ["anio"]))
    return rounded(agg.withColumns(cols))


register("rank_quality", with_fact(f"""
SELECT anio, Municipio, round(valid_pct, 6) AS valid_pct, round(office_pct, 6) AS office_pct,
  round(coordinator_pct, 6) AS coordinator_pct,
  CASE WHEN valid_pct IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY anio ORDER BY coalesce(valid_pct, 0) DESC) AS BIGINT) END AS valid_rank,
  CASE WHEN office_pct IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY anio ORDER BY coalesce(office_pct, 0) DESC) AS BIGINT) END AS office_rank,
  CASE WHEN coordinator_pct IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY anio ORDER BY coalesce(coordinator_pct, 0) DESC) AS BIGINT) END AS coordinator_rank
FROM (SELECT anio, Municipio, {SQL['valid_pct']} AS valid_pct, {SQL['office_pct']} AS office_pct,
        {SQL['coordinator_pct']} AS coordinator_pct FROM fact GROUP BY 1, 2) t
"""))(rank_quality)


# ---------------------------------------------------------------- M9
def top_municipality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank-1 picks per year: the rate re-aggregated over all rank-1
    municipalities, the name only when exactly one is at rank 1, the count
    summed over ties, and the leader's share of all MPI persons."""
    agg = evaluate(fact(spark, sf_dir), ["anio", "Municipio"], ["persons", "mpi_persons", "mpi_rate"])
    ranked = agg.withColumns({"r_rate": dense_rank_of(q("mpi_rate"), ["anio"]),
                              "r_vol": dense_rank_of(q("mpi_persons"), ["anio"])})
    one_rate, one_vol = q("r_rate") == 1, q("r_vol") == 1
    out = ranked.groupBy("anio").agg(
        div0(F.sum(F.when(one_rate, q("mpi_persons"))), F.sum(F.when(one_rate, q("persons")))).alias("top_mpi_rate"),
        F.when(F.count_if(one_rate) == 1, F.max(F.when(one_rate, q("Municipio")))).alias("top_mpi_municipality"),
        F.when(F.count_if(one_vol) == 1, F.max(F.when(one_vol, q("Municipio")))).alias("top_mpi_persons_municipality"),
        F.sum(F.when(one_vol, q("mpi_persons"))).alias("top_mpi_persons"),
        div(F.sum(F.when(one_vol, q("mpi_persons"))), F.sum(q("mpi_persons"))).alias("top_mpi_share"),
    )
    out = out.withColumn("top_mpi_text", F.concat(F.coalesce(q("top_mpi_municipality"), F.lit("")),
                                                  F.lit(S.TXT_MAX_IPM), pct1(q("top_mpi_rate"))))
    return rounded(out)


register("top_municipality", with_fact(f"""
SELECT anio, round(top_mpi_rate, 6) AS top_mpi_rate, top_mpi_municipality, top_mpi_persons_municipality,
  CAST(top_mpi_persons AS BIGINT) AS top_mpi_persons, round(top_mpi_share, 6) AS top_mpi_share,
  coalesce(top_mpi_municipality, '') || {lit(S.TXT_MAX_IPM)} || {_pct1('top_mpi_rate')} AS top_mpi_text
FROM (
  SELECT anio,
    {sdiv0('sum(CASE WHEN r_rate = 1 THEN mpi_persons END)', 'sum(CASE WHEN r_rate = 1 THEN persons END)')} AS top_mpi_rate,
    CASE WHEN count(*) FILTER (WHERE r_rate = 1) = 1 THEN max(CASE WHEN r_rate = 1 THEN Municipio END) END AS top_mpi_municipality,
    CASE WHEN count(*) FILTER (WHERE r_vol = 1) = 1 THEN max(CASE WHEN r_vol = 1 THEN Municipio END) END AS top_mpi_persons_municipality,
    sum(CASE WHEN r_vol = 1 THEN mpi_persons END) AS top_mpi_persons,
    {sdiv('sum(CASE WHEN r_vol = 1 THEN mpi_persons END)', 'sum(mpi_persons)')} AS top_mpi_share
  FROM (SELECT *, dense_rank() OVER (PARTITION BY anio ORDER BY coalesce(mpi_rate, 0) DESC) AS r_rate,
               dense_rank() OVER (PARTITION BY anio ORDER BY coalesce(mpi_persons, 0) DESC) AS r_vol
        FROM (SELECT anio, Municipio, {P} AS persons, {cnt(MPI)} AS mpi_persons, {SQL['mpi_rate']} AS mpi_rate
              FROM fact GROUP BY 1, 2) a) r
  GROUP BY anio) t
"""))(top_municipality)


def largest_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TOPN(1) keeps ties and MAXX takes the greatest name among them."""
    agg = evaluate(fact(spark, sf_dir), ["anio", "Municipio"], ["mpi_persons"])
    top = agg.withColumn("r", dense_rank_of(q("mpi_persons"), ["anio"]))
    out = top.groupBy("anio").agg(
        F.max(F.when(q("r") == 1, q("Municipio"))).alias("largest_volume_municipality"),
        div(F.sum(F.when(q("r") == 1, q("mpi_persons"))), F.sum(q("mpi_persons"))).alias("leader_share"))
    return rounded(out)


register("largest_volume", with_fact(f"""
SELECT anio, max(CASE WHEN r = 1 THEN Municipio END) AS largest_volume_municipality,
  round({sdiv('sum(CASE WHEN r = 1 THEN mpi_persons END)', 'sum(mpi_persons)')}, 6) AS leader_share
FROM (SELECT *, dense_rank() OVER (PARTITION BY anio ORDER BY coalesce(mpi_persons, 0) DESC) AS r
      FROM (SELECT anio, Municipio, {cnt(MPI)} AS mpi_persons FROM fact GROUP BY 1, 2) a) t
GROUP BY anio
"""))(largest_volume)


def top_subregion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subregions at the highest incidence, names joined in sorted order."""
    agg = evaluate(fact(spark, sf_dir), ["anio", "Subregion"], ["incidence"])
    mx = agg.withColumn("mx", F.max("incidence").over(Window.partitionBy("anio")))
    out = mx.groupBy("anio").agg(F.array_join(F.array_sort(F.collect_list(
        F.when(q("incidence") == q("mx"), q("Subregion")))), ", ").alias("top_incidence_subregion"))
    return out


register("top_subregion", with_fact(f"""
SELECT anio, array_to_string(list_sort(list(Subregion) FILTER (WHERE incidence = mx)), ', ') AS top_incidence_subregion
FROM (SELECT *, max(incidence) OVER (PARTITION BY anio) AS mx
      FROM (SELECT anio, Subregion, {SQL['incidence']} AS incidence FROM fact GROUP BY 1, 2) a) t
GROUP BY anio
"""))(top_subregion)


# ---------------------------------------------------------------- M10
def _yoy(spark: SparkSession, sf_dir: str, keys: list[str]) -> DataFrame:
    """Rate at the latest year in context and at the calendar year before it
    (a missing year gives 0 through DIVIDE's alternate), and the change."""
    by_year = evaluate(fact(spark, sf_dir), keys + ["anio"], ["persons", "mpi_persons"])
    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    y = by_year.withColumn("mx", F.max("anio").over(w))
    cur, prev = q("anio") == q("mx"), q("anio") == q("mx") - 1
    out = y.groupBy(*keys).agg(
        F.max("mx").alias("max_year"),
        div0(F.sum(F.when(cur, q("mpi_persons"))), F.sum(F.when(cur, q("persons")))).alias("mpi_rate_current_year"),
        div0(F.sum(F.when(prev, q("mpi_persons"))), F.sum(F.when(prev, q("persons")))).alias("mpi_rate_previous_year"))
    return out.withColumn("mpi_change", blank_sub(q("mpi_rate_current_year"), q("mpi_rate_previous_year")))


def year_on_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _yoy(spark, sf_dir, ["Subregion", "Municipio"])
    out = out.withColumns({"rise_rank": dense_rank_of(q("mpi_change"), ["Subregion"]),
                           "fall_rank": dense_rank_of(q("mpi_change"), ["Subregion"], descending=False)})
    return rounded(out)


def _yoy_sql(keys: str) -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    grp = f"GROUP BY {keys}" if keys else ""
    sel = f"{keys}, " if keys else ""
    return f"""(SELECT {sel}max(mx) AS max_year,
    {sdiv0('sum(CASE WHEN anio = mx THEN mpi_persons END)', 'sum(CASE WHEN anio = mx THEN persons END)')} AS cur,
    {sdiv0('sum(CASE WHEN anio = mx - 1 THEN mpi_persons END)', 'sum(CASE WHEN anio = mx - 1 THEN persons END)')} AS prev
  FROM (SELECT *, max(anio) OVER ({part}) AS mx FROM (
        SELECT {sel}anio, {P} AS persons, {cnt(MPI)} AS mpi_persons FROM fact GROUP BY {sel}anio) a) b
  {grp})"""


register("year_on_year", with_fact(f"""
SELECT Subregion, Municipio, max_year, round(cur, 6) AS mpi_rate_current_year, round(prev, 6) AS mpi_rate_previous_year,
  round({bsub('cur', 'prev')}, 6) AS mpi_change,
  CAST(dense_rank() OVER (PARTITION BY Subregion ORDER BY coalesce({bsub('cur', 'prev')}, 0) DESC) AS BIGINT) AS rise_rank,
  CAST(dense_rank() OVER (PARTITION BY Subregion ORDER BY coalesce({bsub('cur', 'prev')}, 0) ASC) AS BIGINT) AS fall_rank
FROM {_yoy_sql('Subregion, Municipio')} t
"""))(year_on_year)


def largest_rise_and_fall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over all municipalities: who rose and fell most, by how much, and the
    sentences (the change is printed as a fraction with one decimal)."""
    per = _yoy(spark, sf_dir, ["Municipio"])
    r = per.withColumns({"r_up": dense_rank_of(q("mpi_change"), []),
                         "r_dn": dense_rank_of(q("mpi_change"), [], descending=False)})
    up, dn = q("r_up") == 1, q("r_dn") == 1
    out = r.agg(
        F.when(F.count_if(up) == 1, F.max(F.when(up, q("Municipio")))).alias("largest_rise_municipality"),
        F.max(F.when(up, q("mpi_change"))).alias("largest_rise"),
        F.when(F.count_if(dn) == 1, F.max(F.when(dn, q("Municipio")))).alias("largest_fall_municipality"),
        F.max(F.when(dn, q("mpi_change"))).alias("largest_fall"))
    out = out.withColumns({
        "rise_text": F.concat(F.coalesce(q("largest_rise_municipality"), F.lit("")), F.lit(S.TXT_RISE),
                              F.format_number(q("largest_rise"), 1), F.lit(S.TXT_PP)),
        "fall_text": F.concat(F.coalesce(q("largest_fall_municipality"), F.lit("")), F.lit(S.TXT_FALL),
                              F.format_number(q("largest_fall"), 1), F.lit(S.TXT_PP)),
    })
    return rounded(out)


register("largest_rise_and_fall", with_fact(f"""
SELECT largest_rise_municipality, round(largest_rise, 6) AS largest_rise,
  largest_fall_municipality, round(largest_fall, 6) AS largest_fall,
  coalesce(largest_rise_municipality, '') || {lit(S.TXT_RISE)} || format('{{:,.1f}}', largest_rise) || {lit(S.TXT_PP)} AS rise_text,
  coalesce(largest_fall_municipality, '') || {lit(S.TXT_FALL)} || format('{{:,.1f}}', largest_fall) || {lit(S.TXT_PP)} AS fall_text
FROM (SELECT
    CASE WHEN count(*) FILTER (WHERE r_up = 1) = 1 THEN max(CASE WHEN r_up = 1 THEN Municipio END) END AS largest_rise_municipality,
    max(CASE WHEN r_up = 1 THEN chg END) AS largest_rise,
    CASE WHEN count(*) FILTER (WHERE r_dn = 1) = 1 THEN max(CASE WHEN r_dn = 1 THEN Municipio END) END AS largest_fall_municipality,
    max(CASE WHEN r_dn = 1 THEN chg END) AS largest_fall
  FROM (SELECT *, dense_rank() OVER (ORDER BY coalesce(chg, 0) DESC) AS r_up,
               dense_rank() OVER (ORDER BY coalesce(chg, 0) ASC) AS r_dn
        FROM (SELECT Municipio, {bsub('cur', 'prev')} AS chg FROM {_yoy_sql('Municipio')} y) c) r) t
"""))(largest_rise_and_fall)


# ---------------------------------------------------------------- M11
def pareto_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    agg = evaluate(fact(spark, sf_dir), ["anio", "Municipio"], ["mpi_persons"])
    cum, pct = pareto(q("mpi_persons"), ["anio"])
    return rounded(agg.withColumns({"mpi_cumulative": cum, "mpi_cumulative_pct": pct,
                                    "mpi_share": share_over(q("mpi_persons"), ["anio"])}))


_CUM = ("CASE WHEN mpi_persons IS NOT NULL THEN sum(mpi_persons) OVER (PARTITION BY anio ORDER BY mpi_persons DESC "
        "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END")
register("pareto", with_fact(f"""
SELECT anio, Municipio, mpi_persons, CAST({_CUM} AS BIGINT) AS mpi_cumulative,
  round({sdiv(_CUM, 'sum(mpi_persons) OVER (PARTITION BY anio)')}, 6) AS mpi_cumulative_pct,
  round({sdiv('mpi_persons', 'sum(mpi_persons) OVER (PARTITION BY anio)')}, 6) AS mpi_share
FROM (SELECT anio, Municipio, {cnt(MPI)} AS mpi_persons FROM fact GROUP BY 1, 2) t
"""))(pareto_query)


# ---------------------------------------------------------------- M15, M16, M14
def dominant_problem(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [m for _, m in S.SERVICE_PROBLEMS]
    agg = evaluate(fact(spark, sf_dir), ["anio", "Subregion"], names)
    mx = F.greatest(*[q(m) for m in names])
    pick = None
    for text, m in S.SERVICE_PROBLEMS:
        pick = F.when(mx == q(m), F.lit(text)) if pick is None else pick.when(mx == q(m), F.lit(text))
    return rounded(agg.select("anio", "Subregion", mx.alias("max_housing_problem"),
                              pick.alias("dominant_problem")))


register("dominant_problem", with_fact(f"""
SELECT anio, Subregion, round(mx, 6) AS max_housing_problem,
  CASE {" ".join(f"WHEN mx = {m} THEN {lit(t)}" for t, m in S.SERVICE_PROBLEMS)} END AS dominant_problem
FROM (SELECT *, greatest({", ".join(m for _, m in S.SERVICE_PROBLEMS)}) AS mx FROM (
  SELECT anio, Subregion, {", ".join(f"{SQL[m]} AS {m}" for _, m in S.SERVICE_PROBLEMS)}
  FROM fact GROUP BY 1, 2) a) t
"""))(dominant_problem)


def subregion_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All subregion names of the territory table plus the "all" row (UNION
    keeps duplicates); a subregion without persons is offered too."""
    names = territory_dim(spark, sf_dir).where(q("Subregion").isNotNull()).select("Subregion").distinct()
    return names.unionByName(spark.range(1).select(F.lit(S.TXT_SUBREGION_ALL).alias("Subregion")))


register("subregion_options",
         f"SELECT DISTINCT r.r_name AS Subregion FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey "
         f"UNION ALL SELECT {lit(S.TXT_SUBREGION_ALL)} AS Subregion")(subregion_options)


def labels_and_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card and label texts per subregion and year."""
    agg = evaluate(fact(spark, sf_dir), ["anio", "Subregion"], ["persons", "mpi_persons", "mpi_rate",
                                                              "poverty_persons"])
    return agg.select(
        "anio", "Subregion",
        F.concat(F.format_number(q("mpi_persons") / 1e6, 1), F.lit(S.TXT_MILLIONS)).alias("mpi_subtext"),
        F.concat(F.format_number(q("poverty_persons") / 1e6, 1), F.lit(S.TXT_POVERTY_MILLIONS)).alias("poverty_subtext"),
        F.format_number(q("persons"), 0).alias("bar_label_by_group"),
        F.concat(F.format_number(q("mpi_persons"), 0), F.lit(S.TXT_MPI_CARD), pct1(q("mpi_rate"))).alias("mpi_card"),
        F.concat(F.lit(S.TXT_SELECTED_YEAR), q("anio").cast("string")).alias("selected_year_text"),
    )


register("labels_and_titles", with_fact(f"""
SELECT anio, Subregion,
  format('{{:,.1f}}', mpi_persons / 1e6) || {lit(S.TXT_MILLIONS)} AS mpi_subtext,
  format('{{:,.1f}}', poverty_persons / 1e6) || {lit(S.TXT_POVERTY_MILLIONS)} AS poverty_subtext,
  {_fmt0('persons')} AS bar_label_by_group,
  {_fmt0('mpi_persons')} || {lit(S.TXT_MPI_CARD)} || {_pct1('mpi_rate')} AS mpi_card,
  {lit(S.TXT_SELECTED_YEAR)} || CAST(anio AS VARCHAR) AS selected_year_text
FROM (SELECT anio, Subregion, {P} AS persons, {cnt(MPI)} AS mpi_persons, {SQL['mpi_rate']} AS mpi_rate,
        {SQL['poverty_persons']} AS poverty_persons FROM fact GROUP BY 1, 2) t
"""))(labels_and_titles)


def group_bar_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bar label per group: persons and the group's share of the row total
    (the group filter removed)."""
    agg = evaluate(fact(spark, sf_dir), ["Subregion", "grupo_sisben"], ["persons"])
    out = agg.withColumn("pct_group", share_over(q("persons"), ["Subregion"]))
    out = out.withColumn("bar_label", F.concat(F.format_number(q("persons"), 0), F.lit(" ("),
                                               pct1(q("pct_group")), F.lit(")")))
    return rounded(out)


register("group_bar_labels", with_fact(f"""
SELECT Subregion, grupo_sisben, persons, round(pct_group, 6) AS pct_group,
  {_fmt0('persons')} || ' (' || {_pct1('pct_group')} || ')' AS bar_label
FROM (SELECT *, CAST(persons AS DOUBLE) / nullif(sum(persons) OVER (PARTITION BY Subregion), 0) AS pct_group
      FROM (SELECT Subregion, grupo_sisben, {P} AS persons FROM fact GROUP BY 1, 2) a) t
"""))(group_bar_labels)
