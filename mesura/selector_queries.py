"""Selector measures (M13): a parameter table picks which measure a row
shows. Spark form: evaluate all candidate measures in one fused aggregate,
then ``stack`` them into (label, value) rows. A label whose branch is
missing yields null, as the SWITCH without default does."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mesura import schemas as S
from mesura.catalog import register
from mesura.functions.blank import div
from mesura.plans.analytics import q
from mesura.plans.evaluate import evaluate, rounded
from mesura.plans.measures import BASES, EVENT_NAMES, EVENTS, EXPENSES, MEASURES, head
from mesura.sources.survey import fact
from mesura.sqlfact import lit, with_fact
from mesura.sqlmeasures import DW, SQL, cnt

KEYS = ["anio", "Subregion"]


def stack_rows(df: DataFrame, keys: list[str], branches: list[tuple[str, Column | None]],
               label: str, value: str = "value") -> DataFrame:
    """One output row per (key combination, label)."""
    args = []
    for text, c in branches:
        args += [F.lit(text), (c if c is not None else F.lit(None)).cast("double")]
    return df.select(*[q(k) for k in keys], F.stack(F.lit(len(branches)), *args).alias(label, value))


def _union_sql(keys: str, branches: list[tuple[str, str | None]], label: str, src: str,
               digits: int | None = 6) -> str:
    def val(x):
        v = f"CAST({x if x else 'NULL'} AS DOUBLE)"
        return f"round({v}, {digits})" if digits is not None else v
    return " UNION ALL ".join(f"SELECT {keys}, {lit(t)} AS {label}, {val(x)} AS value FROM {src}"
                              for t, x in branches)


# ---------------------------------------------------------------- indicators
IND_BRANCHES = [(label, f"pct_i{k}") for k, (label, _) in enumerate(S.INDICATOR_ROWS, start=1)]
IND_CATEGORY = dict(S.INDICATOR_ROWS)


def select_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per indicator with its category, the mean over the labels of
    the category (several labels selected) and the heat-map title."""
    agg = evaluate(fact(spark, sf_dir), KEYS, [m for _, m in IND_BRANCHES])
    rows = stack_rows(agg, KEYS, [(t, q(m)) for t, m in IND_BRANCHES], "indicator")
    cat = F.create_map(*[x for t in IND_CATEGORY.items() for x in (F.lit(t[0]), F.lit(t[1]))])
    rows = rows.withColumn("category", F.element_at(cat, q("indicator")))
    w = Window.partitionBy(*KEYS, "category")
    return rounded(rows.withColumns({
        "category_mean": F.avg("value").over(w),
        "heatmap_title": F.concat(F.lit(S.TXT_MPI_HEATMAP), q("category"))}))


_cat_values = ", ".join(f"({lit(a)}, {lit(b)})" for a, b in S.INDICATOR_ROWS)
register("select_indicator", with_fact(f"""
SELECT anio, Subregion, u.indicator, round(u.value, 6) AS value, c.category,
  round(avg(u.value) OVER (PARTITION BY anio, Subregion, c.category), 6) AS category_mean,
  {lit(S.TXT_MPI_HEATMAP)} || c.category AS heatmap_title
FROM ({_union_sql('anio, Subregion', IND_BRANCHES, 'indicator', 'a', None)}) u
JOIN (VALUES {_cat_values}) c(indicator, category) ON u.indicator = c.indicator
""", "a AS (SELECT anio, Subregion, " + ", ".join(f"{SQL[m]} AS {m}" for _, m in IND_BRANCHES) +
    " FROM fact GROUP BY 1, 2)"))(select_indicator)


# ---------------------------------------------------------------- household
HH_MEASURES = ["pct_hh_water_7days", "pct_hh_kitchen", "pct_hh_fridge", "pct_hh_washer", "pct_hh_pc",
               "pct_hh_internet", "pct_hh_motorbike", "pct_hh_car", "pct_hh_tractor", "pct_hh_property"]
SPEND = [f"mean_spend_{k}" for k in EXPENSES] + ["mean_spend_total"]
HH_BRANCHES = [(label, m) for (label, _), m in zip(S.HOUSEHOLD_INDICATOR_ROWS, HH_MEASURES + SPEND)]


def select_household(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Household indicator selector: condition shares, per-household-number
    expense means (two-level) and the total expense mean, typed by label. One
    pass: counts and sums of the finer aggregate add up to the coarser one."""
    cols = {f"mean_spend_{k}": f"vlr_gasto_{v}" for k, v in EXPENSES.items()}
    ratios = [MEASURES[m] for m in HH_MEASURES]
    counts = sorted({b for m in ratios for b in m.needs})
    spent = F.when(head(), q("vlr_total_gastos"))
    fine = (fact(spark, sf_dir).groupBy(*KEYS, "ide_hogar")
            .agg(*[BASES[b].make().alias(b) for b in counts], *[F.max(c).alias(n) for n, c in cols.items()],
                 F.sum(spent).alias("__spent"), F.count(spent).alias("__heads")))
    agg = fine.groupBy(*KEYS).agg(*[F.sum(b).alias(b) for b in counts], *[F.avg(n).alias(n) for n in cols],
                                  div(F.sum("__spent"), F.sum("__heads")).alias("mean_spend_total"))
    both = agg.select(*KEYS, *[m.value(q).alias(m.name) for m in ratios], *cols, "mean_spend_total")
    rows = stack_rows(both, KEYS, [(t, q(m)) for t, m in HH_BRANCHES], "indicator")
    cat = F.create_map(*[x for a, b in S.HOUSEHOLD_INDICATOR_ROWS for x in (F.lit(a), F.lit(b))])
    kind = F.when(q("indicator").contains("Gasto"), "Gasto").otherwise("Condiciones")
    rows = rows.withColumns({"category": F.element_at(cat, q("indicator")), "kind": kind})
    return rounded(rows.withColumns({
        "value_pct": F.when(q("kind") == "Condiciones", q("value")),
        "value_spend": F.when(q("kind") == "Gasto", q("value")),
        "heatmap_title": F.concat(F.lit(S.TXT_HOUSEHOLD_HEATMAP), q("category"))}))


_hh_values = ", ".join(f"({lit(a)}, {lit(b)})" for a, b in S.HOUSEHOLD_INDICATOR_ROWS)
_spend_cols = {f"mean_spend_{k}": f"vlr_gasto_{v}" for k, v in EXPENSES.items()}
register("select_household", with_fact(f"""
SELECT u.*, c.category, CASE WHEN u.indicator LIKE '%Gasto%' THEN 'Gasto' ELSE 'Condiciones' END AS kind,
  CASE WHEN u.indicator NOT LIKE '%Gasto%' THEN u.value END AS value_pct,
  CASE WHEN u.indicator LIKE '%Gasto%' THEN u.value END AS value_spend,
  {lit(S.TXT_HOUSEHOLD_HEATMAP)} || c.category AS heatmap_title
FROM ({_union_sql('anio, Subregion', HH_BRANCHES, 'indicator', 'a')}) u
JOIN (VALUES {_hh_values}) c(indicator, category) ON u.indicator = c.indicator
""", "a AS (SELECT x.*, " + ", ".join(f"s.{n}" for n in _spend_cols) + " FROM (SELECT anio, Subregion, " +
    ", ".join(f"{SQL[m]} AS {m}" for m in HH_MEASURES + ['mean_spend_total']) +
    " FROM fact GROUP BY 1, 2) x LEFT JOIN (SELECT anio, Subregion, " +
    ", ".join(f"avg({n}) AS {n}" for n in _spend_cols) + " FROM (SELECT anio, Subregion, ide_hogar, " +
    ", ".join(f"max({c}) AS {n}" for n, c in _spend_cols.items()) +
    " FROM fact GROUP BY 1, 2, 3) h GROUP BY 1, 2) s ON x.anio = s.anio AND x.Subregion = s.Subregion)"))(
    select_household)


# ---------------------------------------------------------------- housing matrix
SERVICE_BRANCH = {t: m for t, m in S.SERVICE_PROBLEMS}
SELECTED_TYPES = ["Pisos", "Paredes"]


def _matrix_branches():
    out = []
    floors = [r for r in S.HOUSING_CATEGORY_ROWS if r[1] == "Pisos"]
    walls = [r for r in S.HOUSING_CATEGORY_ROWS if r[1] == "Paredes"]
    for code, (label, _) in enumerate(floors, start=1):
        out.append((label, "Pisos", f"floor_{code}", True))
    for code, (label, _) in enumerate(walls):
        out.append((label, "Paredes", f"wall_{code}", True))
    for label, kind in S.HOUSING_CATEGORY_ROWS:
        if kind == "Servicios":
            out.append((label, "Servicios", SERVICE_BRANCH.get(label), False))
    return out


MATRIX = _matrix_branches()


def select_material(spark: SparkSession, sf_dir: str, selected: Sequence[str] = SELECTED_TYPES) -> DataFrame:
    """Housing matrix: material counts over the subregion's dwellings of all
    years (ALLEXCEPT), service shares as they are; plus the type filter flag
    (1 when the row's type is among the selected types)."""
    services = [MEASURES[m] for _, m in S.SERVICE_PROBLEMS]
    needs = sorted({b for m in services for b in m.needs} | {"DW"})
    agg = fact(spark, sf_dir).groupBy(*KEYS).agg(
        *[BASES[f"DW_FLOOR_{c}"].make().alias(f"floor_{c}") for c in range(1, 7)],
        *[BASES[f"DW_WALL_{c}"].make().alias(f"wall_{c}") for c in range(0, 8)],
        *[BASES[b].make().alias(b) for b in needs])
    # dwellings add up over the years: the subregion's total is a window over the aggregate
    j = (agg.withColumn("subregion_dwellings", F.sum("DW").over(Window.partitionBy("Subregion")))
            .withColumns({m.name: m.value(q) for m in services}))
    branches = []
    for label, kind, col, is_count in MATRIX:
        if col is None:
            branches.append((label, None))
        elif is_count:
            branches.append((label, q(col) / F.nullif(q("subregion_dwellings"), F.lit(0))))
        else:
            branches.append((label, q(col)))
    rows = stack_rows(j, KEYS, branches, "category")
    kinds = F.create_map(*[x for label, kind, _, _ in MATRIX for x in (F.lit(label), F.lit(kind))])
    rows = rows.withColumn("kind", F.element_at(kinds, q("category")))
    rows = rows.withColumn("type_filter", q("kind").isin(*selected).cast("long"))
    return rounded(rows)


def _matrix_sql():
    branches = []
    for label, kind, col, is_count in MATRIX:
        if col is None:
            branches.append((label, None))
        elif is_count:
            branches.append((label, f"CAST({col} AS DOUBLE) / nullif(subregion_dwellings, 0)"))
        else:
            branches.append((label, col))
    kinds = ", ".join(f"({lit(label)}, {lit(kind)})" for label, kind, _, _ in MATRIX)
    sel = ", ".join(f"({lit(t)})" for t in SELECTED_TYPES)
    a = ("a AS (SELECT c.*, b.subregion_dwellings FROM (SELECT anio, Subregion, " +
         ", ".join([f"{cnt(f'{DW} AND tip_mat_pisos = {k}')} AS floor_{k}" for k in range(1, 7)] +
                   [f"{cnt(f'{DW} AND coalesce(tip_mat_paredes, 0) = 0')} AS wall_0"] +
                   [f"{cnt(f'{DW} AND tip_mat_paredes = {k}')} AS wall_{k}" for k in range(1, 8)] +
                   [f"{SQL[m]} AS {m}" for _, m in S.SERVICE_PROBLEMS]) +
         f" FROM fact GROUP BY 1, 2) c LEFT JOIN (SELECT Subregion, {cnt(DW)} AS subregion_dwellings FROM fact "
         "GROUP BY 1) b ON c.Subregion = b.Subregion)")
    body = f"""
SELECT u.*, k.kind, CAST(CASE WHEN s.t IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS type_filter
FROM ({_union_sql('anio, Subregion', branches, 'category', 'a')}) u
JOIN (VALUES {kinds}) k(category, kind) ON u.category = k.category
LEFT JOIN (VALUES {sel}) s(t) ON k.kind = s.t
"""
    return with_fact(body, a)


register("select_material", _matrix_sql())(select_material)


# ---------------------------------------------------------------- events, deprivation, service heat map
def _simple_selector(branches: list[tuple[str, str | None]], label: str, extra: list[str] | None = None):
    names = [m for _, m in branches if m] + (extra or [])

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        agg = evaluate(fact(spark, sf_dir), KEYS, names)
        return rounded(stack_rows(agg, KEYS, [(t, q(m) if m else None) for t, m in branches], label))

    sql = with_fact(f"SELECT * FROM ({_union_sql('anio, Subregion', branches, label, 'a')}) u",
                    "a AS (SELECT anio, Subregion, " + ", ".join(f"{SQL[m]} AS {m}" for m in names) +
                    " FROM fact GROUP BY 1, 2)")
    return run, sql


EVENT_LABEL = dict(zip(EVENTS, S.EVENT_ROWS))
_ev_run, _ev_sql = _simple_selector([(EVENT_LABEL[e], f"pct_{EVENT_NAMES[e]}") for e in EVENTS], "event")
register("select_event", _ev_sql)(_ev_run)
_evm_run, _evm_sql = _simple_selector([(EVENT_LABEL[e], f"selected_mean_{EVENT_NAMES[e]}s") for e in EVENTS], "event")
register("select_event_means", _evm_sql)(_evm_run)
_dep_run, _dep_sql = _simple_selector(list(zip(S.DEPRIVATION_ROWS, ["pct_no_water", "pct_poor_sanitation",
                                                                    "pct_poor_floors", "pct_poor_walls",
                                                                    "pct_crowded"])), "deprivation")
register("select_deprivation", _dep_sql)(_dep_run)
_srv_run, _srv_sql = _simple_selector([(t, SERVICE_BRANCH.get(t)) for t, _ in S.HOUSING_INDICATOR_ROWS],
                                      "service")
register("select_service", _srv_sql)(_srv_run)


# ---------------------------------------------------------------- single visible value
SANITARY_COLS = ["tip_sanitario", "tip_ubi_sanitario", "tip_uso_sanitario", "tip_origen_agua"]


def _single(c: Column) -> Column:
    """The one visible value: least and greatest are equal and none is missing
    (plain partial aggregates, no distinct count)."""
    return F.when((F.min(c) == F.max(c)) & (F.count(c) == F.count(F.lit(1))), F.max(c))


def _single_sql(c: str) -> str:
    return f"CASE WHEN count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) = 1 THEN max({c}) END"


def select_sanitary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active sanitary variable: the one visible code of the chosen block's
    column, null when several are visible (grouped by sanitary type)."""
    keys = ["Subregion", "tip_sanitario"]
    agg = fact(spark, sf_dir).groupBy(*keys).agg(*[_single(q(c)).alias(c + "_v") for c in SANITARY_COLS])
    return stack_rows(agg, keys, [(b, q(c + "_v")) for b, c in zip(S.SANITARY_BLOCK_ROWS, SANITARY_COLS)],
                      "block")


register("select_sanitary", with_fact(
    " UNION ALL ".join(f"SELECT Subregion, tip_sanitario, {lit(b)} AS block, CAST({_single_sql(c)} AS DOUBLE) AS value "
                       f"FROM fact GROUP BY 1, 2" for b, c in zip(S.SANITARY_BLOCK_ROWS, SANITARY_COLS))))(
    select_sanitary)


def select_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Axis selector: the visible group or the visible detailed class."""
    keys = ["Subregion", "grupo_sisben"]
    agg = fact(spark, sf_dir).groupBy(*keys).agg(_single(q("grupo_sisben")).alias("g"),
                                                 _single(q("Clasificacion")).alias("c"))
    return agg.select(*keys, F.stack(F.lit(2), F.lit(S.LEVEL_ROWS[0]), q("g"), F.lit(S.LEVEL_ROWS[1]), q("c"))
                      .alias("level", "axis_value"))


register("select_axis", with_fact(
    f"SELECT Subregion, grupo_sisben, {lit(S.LEVEL_ROWS[0])} AS level, {_single_sql('grupo_sisben')} AS axis_value "
    f"FROM fact GROUP BY 1, 2 UNION ALL "
    f"SELECT Subregion, grupo_sisben, {lit(S.LEVEL_ROWS[1])}, {_single_sql('Clasificacion')} FROM fact GROUP BY 1, 2"))(
    select_axis)
