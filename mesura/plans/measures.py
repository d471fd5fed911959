"""Measure registry.

A *base* is one aggregate Column evaluated on fact rows (a conditional count,
a sum, a conditional mean). A *measure* is an expression over base columns,
computed after aggregation (ratios are never averaged). ``evaluate`` fuses the
bases of all requested measures into one ``groupBy(keys).agg(...)``.

Window-based measures (shares with filters removed, ranks, rank-1 picks,
year on year, Pareto) live in ``mesura.plans.analytics``; they are listed in
``ANALYTIC_REFS`` so that the inventory stays complete.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from mesura import schemas as S
from mesura.functions.blank import (blank_count, blank_sub, div, div0,
                                    distinct_count_with_blank)


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def head() -> Column:
    """Household grain: the row of a household head."""
    return col("tip_parentesco") == 1


def dwell() -> Column:
    """Dwelling grain: the head of the first household of the dwelling."""
    return (col("tip_parentesco") == 1) & (col("ide_hogar") == 1)


def mpi_person() -> Column:
    """Person counted as multidimensionally poor (prefix test on the text)."""
    return F.substring(F.trim(col("H_5").cast("string")), 1, 1) == "1"


def quality_ordinal() -> Column:
    return (F.when(col("Nivel_Calidad_Vivienda") == S.HOUSING_QUALITY[0], 0)
             .when(col("Nivel_Calidad_Vivienda") == S.HOUSING_QUALITY[1], 1)
             .when(col("Nivel_Calidad_Vivienda") == S.HOUSING_QUALITY[2], 2))


GRAIN_COLS = ("tip_parentesco",)
DWELL_COLS = ("tip_parentesco", "ide_hogar")


@dataclass(frozen=True)
class Base:
    name: str
    make: Callable[[], Column]
    filter_cols: tuple[str, ...] = ()     # columns its own filter replaces (rule B12)
    additive: bool = True                 # a sum of it over finer groups is valid


@dataclass(frozen=True)
class Measure:
    name: str
    ref: int
    needs: tuple[str, ...]
    value: Callable[[Callable[[str], Column]], Column]


BASES: dict[str, Base] = {}
MEASURES: dict[str, Measure] = {}


def base(name, make, filter_cols=(), additive=True):
    BASES[name] = Base(name, make, tuple(filter_cols), additive)


def measure(ref, name, needs, value=None):
    needs = tuple([needs] if isinstance(needs, str) else needs)
    if value is None:
        value = (lambda b, n=needs[0]: b(n))
    MEASURES[name] = Measure(name, ref, needs, value)


# ----------------------------------------------------------------- bases
base("P", lambda: blank_count())
base("ROWS", lambda: F.count(F.lit(1)))
base("HH", lambda: blank_count(head()), GRAIN_COLS)
base("DW", lambda: blank_count(dwell()), DWELL_COLS)
base("PIPM", lambda: blank_count(mpi_person()), ("H_5",))
base("POOR_HH", lambda: blank_count(head() & (col("H_5") == 1)), GRAIN_COLS + ("H_5",))
for g in "ABCD":
    base(f"G{g}", lambda g=g: blank_count(col("grupo_sisben") == g), ("grupo_sisben",))
base("GAB", lambda: blank_count(col("grupo_sisben").isin("A", "B")), ("grupo_sisben",))
base("MEN", lambda: blank_count(col("sexo_persona") == 1), ("sexo_persona",))
base("WOMEN", lambda: blank_count(col("sexo_persona") == 2), ("sexo_persona",))
base("DISTINCT_CLASS", lambda: distinct_count_with_blank(col("orden_clasificacion")), (), False)
base("MAX_YEAR", lambda: F.max(col("anio")), (), False)
base("MIN_AGE", lambda: F.min(col("Edad")), (), False)
base("MAX_AGE", lambda: F.max(col("Edad")), (), False)

# dwelling-grain conditional counts: name -> (column, predicate)
DW_CONDITIONS = {
    "DW_NO_ENERGY": ("ind_tiene_energia", lambda c: c == 2),
    "DW_NO_WATER_SUPPLY": ("ind_tiene_acueducto", lambda c: c == 2),
    "DW_NO_SEWER": ("ind_tiene_alcantarillado", lambda c: c == 2),
    "DW_NO_GAS": ("ind_tiene_gas", lambda c: c == 2),
    "DW_NO_WASTE": ("ind_tiene_recoleccion", lambda c: c == 2),
    "DW_ENERGY": ("ind_tiene_energia", lambda c: c == 1),
    "DW_WATER_SUPPLY": ("ind_tiene_acueducto", lambda c: c == 1),
    "DW_GAS": ("ind_tiene_gas", lambda c: c == 1),
    "DW_POOR_FLOOR": ("tip_mat_pisos", lambda c: c.isin(4, 5, 6)),
    "DW_POOR_WALL": ("tip_mat_paredes", lambda c: c.isin(3, 4, 5, 6, 7)),
    "DW_DEPRIVED": ("Privaciones_Vivienda", lambda c: c > 0),
    "DW_DEPRIVED_1": ("Privaciones_Vivienda", lambda c: c >= 1),
    "DW_NO_WATER": ("I11", lambda c: c == 1),
    "DW_POOR_SANITATION": ("I12", lambda c: c == 1),
    "DW_CROWDED": ("Cat_Hacinamiento", lambda c: c == S.CROWDED),
    "DW_CROWDED_OBS": ("Personas_por_Cuarto", lambda c: c > 3),
    "DW_RURAL": ("Cod_clase", lambda c: c == 3),
    "DW_MULTI_HH": ("num_hogares_vivienda", lambda c: c > 1),
    "DW_MALE_HEAD": ("Sexo_Jefe", lambda c: c == 1),
    "DW_FEMALE_HEAD": ("Sexo_Jefe", lambda c: c == 2),
}
EVENTS = ["inundacion", "avalancha", "terremoto", "incendio", "vendaval", "hundimiento"]
EVENT_NAMES = dict(zip(EVENTS, ["flood", "avalanche", "earthquake", "fire", "windstorm", "subsidence"]))
EVENT_COUNT_COLUMN = {e: f"num_evento_{e}" for e in EVENTS}
EVENT_COUNT_COLUMN["vendaval"] = "Num_evento_vendaval"
for e in EVENTS:
    DW_CONDITIONS[f"DW_EVENT_{e}"] = (f"ind_evento_{e}", lambda c: c == 1)
# material counts by code for the housing matrix
for code in range(1, 7):
    DW_CONDITIONS[f"DW_FLOOR_{code}"] = ("tip_mat_pisos", lambda c, code=code: c == code)
for code in range(0, 8):
    # "= 0" also catches BLANK (rule B4)
    DW_CONDITIONS[f"DW_WALL_{code}"] = (
        "tip_mat_paredes",
        (lambda c: F.coalesce(c, F.lit(0)) == 0) if code == 0 else (lambda c, code=code: c == code))
for name, (cname, pred) in DW_CONDITIONS.items():
    base(name, lambda cname=cname, pred=pred: blank_count(dwell() & pred(col(cname))),
         DWELL_COLS + (cname,))

# household-grain conditional counts
HH_ASSETS = {  # measure suffix -> column
    "internet": "ind_tiene_internet", "fridge": "ind_tiene_nevera",
    "washer": "ind_tiene_lavadora", "pc": "ind_tiene_pc", "motorbike": "ind_tiene_moto",
    "tractor": "ind_tiene_tractor", "car": "ind_tiene_carro", "property": "ind_tiene_bien_raiz",
    "kitchen": "ind_tiene_cocina", "water_7days": "ind_agua_llega_7dias",
    "water_24h": "ind_agua_llega_24horas",
}
EXPENSES = {  # measure suffix -> column stem
    "food": "alimento", "transport": "transporte", "education": "educacion",
    "health": "salud", "utilities": "serv_publicos", "phone": "celular",
    "rent": "arriendo", "other": "otros",
}
for suffix, cname in HH_ASSETS.items():
    base(f"HH_{suffix}", lambda cname=cname: blank_count(head() & (col(cname) == 1)),
         GRAIN_COLS + (cname,))
for suffix, stem in EXPENSES.items():
    base(f"HH_spend_{suffix}", lambda stem=stem: blank_count(head() & (col(f"ind_gasto_{stem}") == 1)),
         GRAIN_COLS + (f"ind_gasto_{stem}",))
base("HH_solid_fuel", lambda: blank_count(head() & col("tip_energia_cocina").isin(4, 5, 6)),
     GRAIN_COLS + ("tip_energia_cocina",))
base("HH_MALE_HEAD", lambda: blank_count(head() & (col("Sexo_Jefe") == 1)), GRAIN_COLS + ("Sexo_Jefe",))
base("HH_FEMALE_HEAD", lambda: blank_count(head() & (col("Sexo_Jefe") == 2)), GRAIN_COLS + ("Sexo_Jefe",))

# sums
for k in range(1, 16):
    base(f"SUM_I{k}", lambda k=k: F.sum(col(f"I{k}")))
base("SUM_BEDROOMS", lambda: F.sum(col("num_cuartos_dormir")))

# conditional means (not additive)
MEANS = {
    "AVG_QUALITY": (lambda: F.avg(F.when(col("ide_hogar") == 1, quality_ordinal())), ("ide_hogar",)),
    "AVG_PRIV_HH": (lambda: F.avg(F.when(head(), col("Privaciones_Vivienda"))), GRAIN_COLS),
    "AVG_PRIV_DW": (lambda: F.avg(F.when(dwell(), col("Privaciones_Vivienda"))), DWELL_COLS),
    "AVG_PRIV_RURAL": (lambda: F.avg(F.when(dwell() & (col("Cod_clase") == 3), col("Privaciones_Vivienda"))),
                       DWELL_COLS + ("Cod_clase",)),
    "AVG_PRIV_TOWN": (lambda: F.avg(F.when(dwell() & col("Cod_clase").isin(2, 3), col("Privaciones_Vivienda"))),
                      DWELL_COLS + ("Cod_clase",)),
    "AVG_PRIV_MALE": (lambda: F.avg(F.when(dwell() & (col("Sexo_Jefe") == 1), col("Privaciones_Vivienda"))),
                      DWELL_COLS + ("Sexo_Jefe",)),
    "AVG_PRIV_FEMALE": (lambda: F.avg(F.when(dwell() & (col("Sexo_Jefe") == 2), col("Privaciones_Vivienda"))),
                        DWELL_COLS + ("Sexo_Jefe",)),
    "AVG_ROOMS": (lambda: F.avg(col("num_cuartos_vivienda")), ()),
    "AVG_HH_PER_DW": (lambda: F.avg(col("num_hogares_vivienda")), ()),
    # a mean over filtered rows of the table intersects with the context: it replaces no filter
    "AVG_SPEND_TOTAL": (lambda: F.avg(F.when(head(), col("vlr_total_gastos"))), ()),
}
for e in EVENTS:
    event_mean = lambda e=e: F.avg(F.when(col(f"ind_evento_{e}") == 1, col(EVENT_COUNT_COLUMN[e])))
    MEANS[f"AVG_EVENT_{e}"] = (event_mean, ())
    # the event selector's mean has a plain filter on the flag, which replaces the context's
    MEANS[f"AVG_SELECTED_{e}"] = (event_mean, (f"ind_evento_{e}",))
for name, (mk, fc) in MEANS.items():
    base(name, mk, fc, additive=False)

# data-quality counts
base("VALIDATED", lambda: blank_count(col("estado") == "0"), ("estado",))
base("OFFICE", lambda: blank_count(col("estado").isin(*S.OFFICE_CHECK_STATES)), ("estado",))
base("COORD", lambda: blank_count(col("estado").isin(*S.COORDINATOR_STATES)), ("estado",))
base("NONZERO_STATE", lambda: blank_count((col("estado") != "0") & col("estado").isNotNull()), ("estado",))


# ----------------------------------------------------------------- measures
def _ratio(ref, name, num, den, f=div):
    measure(ref, name, (num, den), lambda b, num=num, den=den, f=f: f(b(num), b(den)))


measure(1, "poor_households", "POOR_HH")
measure(2, "persons", "P")
measure(3, "total_rows", "ROWS")
measure(4, "distinct_classes", "DISTINCT_CLASS")
measure(5, "mpi_persons", "PIPM")
_ratio(6, "mpi_rate", "PIPM", "P", div0)
for i, g in enumerate("ABCD"):
    measure(7 + i, f"persons_{g.lower()}", f"G{g}")
    _ratio(11 + i, f"pct_{g.lower()}", f"G{g}", "P")
measure(16, "poverty_persons", "GAB")
_ratio(17, "poverty_rate", "GAB", "P", div0)
measure(23, "max_year", "MAX_YEAR")
measure(173, "min_age", "MIN_AGE")  # parts of the title
measure(173, "max_age", "MAX_AGE")
_ratio(41, "mpi_incidence_department", "PIPM", "P")
_ratio(46, "incidence", "PIPM", "P")
measure(51, "dwellings", "DW")
_ratio(52, "persons_per_household", "P", "HH")
for ref, name, b in [(53, "pct_no_energy", "DW_NO_ENERGY"), (54, "pct_no_water_supply", "DW_NO_WATER_SUPPLY"),
                     (55, "pct_no_sewer", "DW_NO_SEWER"), (56, "pct_no_gas", "DW_NO_GAS"),
                     (57, "pct_no_waste_collection", "DW_NO_WASTE"), (58, "pct_poor_floors", "DW_POOR_FLOOR"),
                     (60, "pct_no_water", "DW_NO_WATER"), (61, "pct_poor_walls", "DW_POOR_WALL"),
                     (62, "pct_crowded", "DW_CROWDED"), (63, "pct_poor_sanitation", "DW_POOR_SANITATION"),
                     (64, "pct_rural_dwellings", "DW_RURAL"),
                     (69, "pct_dwellings_with_deprivation", "DW_DEPRIVED_1"),
                     (74, "pct_male_head", "DW_MALE_HEAD"), (75, "pct_female_head", "DW_FEMALE_HEAD"),
                     (81, "pct_crowded_observed", "DW_CROWDED_OBS"),
                     (92, "pct_multi_household_dwellings", "DW_MULTI_HH"),
                     (98, "pct_with_energy", "DW_ENERGY"), (99, "pct_with_water_supply", "DW_WATER_SUPPLY"),
                     (100, "pct_with_gas", "DW_GAS")]:
    _ratio(ref, name, b, "DW")
measure(59, "dwellings_with_deprivation", "DW_DEPRIVED")
measure(65, "mean_housing_quality", "AVG_QUALITY")
measure(66, "household_deprivation_score", "AVG_PRIV_HH")
measure(67, "households", "HH")
measure(68, "mean_dwelling_deprivations", "AVG_PRIV_DW")
measure(70, "mean_deprivations_rural", "AVG_PRIV_RURAL")
measure(71, "mean_deprivations_town", "AVG_PRIV_TOWN")
measure(72, "dwellings_male_head", "DW_MALE_HEAD")
measure(73, "dwellings_female_head", "DW_FEMALE_HEAD")
measure(76, "mean_deprivations_male_head", "AVG_PRIV_MALE")
measure(77, "mean_deprivations_female_head", "AVG_PRIV_FEMALE")
measure(78, "deprivation_gap", ("AVG_PRIV_FEMALE", "AVG_PRIV_MALE"),
        lambda b: blank_sub(b("AVG_PRIV_FEMALE"), b("AVG_PRIV_MALE")))
measure(79, "households_male_head", "HH_MALE_HEAD")
measure(80, "households_female_head", "HH_FEMALE_HEAD")
measure(84, "mean_rooms", "AVG_ROOMS")
measure(85, "mean_households_per_dwelling", "AVG_HH_PER_DW")
for i, e in enumerate(EVENTS):
    _ratio(86 + i, f"pct_{EVENT_NAMES[e]}", f"DW_EVENT_{e}", "DW")
for ref, e in [(93, "inundacion"), (94, "avalancha"), (95, "hundimiento"), (96, "incendio"), (97, "terremoto")]:
    measure(ref, f"mean_{EVENT_NAMES[e]}s", f"AVG_EVENT_{e}")
measure(200, "mean_windstorms", "AVG_SELECTED_vendaval")
for e in EVENTS:
    measure(200, f"selected_mean_{EVENT_NAMES[e]}s", f"AVG_SELECTED_{e}")
_ratio(101, "poverty_incidence", "GAB", "P", div0)
for k in range(1, 16):
    _ratio(102 + k, f"pct_i{k}", f"SUM_I{k}", "P", div0)
for ref, suffix in [(119, "internet"), (120, "fridge"), (121, "washer"), (122, "pc"),
                    (123, "motorbike"), (124, "tractor"), (125, "car"), (126, "property"),
                    (145, "kitchen"), (146, "water_7days"), (149, "water_24h")]:
    _ratio(ref, f"pct_hh_{suffix}", f"HH_{suffix}", "HH", div0)
for i, suffix in enumerate(EXPENSES):
    _ratio(127 + i, f"pct_hh_spend_{suffix}", f"HH_spend_{suffix}", "HH", div0)
measure(143, "mean_spend_total", "AVG_SPEND_TOTAL")
_ratio(148, "household_size", "P", "HH")
_ratio(150, "persons_per_bedroom", "P", "SUM_BEDROOMS", div0)
_ratio(151, "pct_hh_solid_fuel", "HH_solid_fuel", "HH", div0)
measure(152, "men_negative", "MEN", lambda b: -b("MEN"))
measure(153, "women", "WOMEN")
measure(154, "pct_men", ("MEN", "P"), lambda b: div(-b("MEN"), b("P")))
_ratio(155, "pct_women", "WOMEN", "P")
for i, g in enumerate("ABCD"):
    measure(162 + i, f"group_{g.lower()}", f"G{g}")
measure(174, "men_pyramid", "MEN")
_ratio(175, "valid_pct", "VALIDATED", "P")
measure(178, "kpi_db_health", ("VALIDATED", "P"), lambda b: div(div(b("VALIDATED"), b("P")), b("P")))
measure(179, "integrity_pct", ("VALIDATED", "P"), lambda b: div(div(b("VALIDATED"), b("P")), b("P")))
measure(180, "validated", "VALIDATED")
measure(182, "office_checks", "OFFICE")
_ratio(183, "office_pct", "OFFICE", "NONZERO_STATE")
measure(185, "coordinator_checks", "COORD")
_ratio(186, "coordinator_pct", "COORD", "NONZERO_STATE")

# Window, rank, selector and text measures (see mesura.plans.analytics and
# mesura.catalog): refs 18-22, 24-40, 42-45, 47-50, 82-83, 118, 135-142,
# 144, 147, 156-161, 166-173, 176-177, 181, 184, 187-205. Ref 15 (a card
# colour) is presentation and not built.
ANALYTIC_REFS = sorted(set(range(1, 206)) - {m.ref for m in MEASURES.values()} - {15})


def get(names) -> list[Measure]:
    return [MEASURES[n] for n in names]

# Where the window, rank, selector and text measures are produced:
# ref -> (output column, registered query).
ANALYTIC_OUTPUTS = {
    18: ("mpi_subtext", "labels_and_titles"), 19: ("mpi_rank", "rank_incidence"),
    20: ("top_mpi_rate", "top_municipality"), 21: ("top_mpi_municipality", "top_municipality"),
    22: ("top_mpi_text", "top_municipality"), 24: ("mpi_rate_current_year", "year_on_year"),
    25: ("mpi_rate_previous_year", "year_on_year"), 26: ("mpi_change", "year_on_year"),
    27: ("rise_rank", "year_on_year"), 28: ("largest_rise_municipality", "largest_rise_and_fall"),
    29: ("rise_text", "largest_rise_and_fall"), 30: ("fall_rank", "year_on_year"),
    31: ("largest_rise", "largest_rise_and_fall"), 32: ("largest_fall_municipality", "largest_rise_and_fall"),
    33: ("largest_fall", "largest_rise_and_fall"), 34: ("fall_text", "largest_rise_and_fall"),
    35: ("mpi_persons_rank", "rank_volume"), 36: ("top_mpi_persons_municipality", "top_municipality"),
    37: ("top_mpi_persons", "top_municipality"), 38: ("mpi_share", "share_of_total"),
    39: ("mpi_cumulative", "pareto"), 40: ("mpi_cumulative_pct", "pareto"),
    42: ("top_mpi_share", "top_municipality"), 43: ("volume_rank", "rank_volume"),
    44: ("largest_volume_municipality", "largest_volume"), 45: ("leader_share", "largest_volume"),
    47: ("top_incidence_subregion", "top_subregion"), 48: ("mpi_share_in_subregion", "share_in_subregion"),
    49: ("mpi_share_in_subregion_all_groups", "share_in_subregion"),
    50: ("mpi_share_in_subregion_selection", "share_in_subregion"),
    82: ("material_share (wall)", "share_fixed_base"), 83: ("material_share (floor)", "share_fixed_base"),
    102: ("poverty_subtext", "labels_and_titles"), 118: ("heatmap_title", "select_indicator"),
    135: ("mean_spend_food", "expense_means"), 136: ("mean_spend_transport", "expense_means"),
    137: ("mean_spend_education", "expense_means"), 138: ("mean_spend_health", "expense_means"),
    139: ("mean_spend_utilities", "expense_means"), 140: ("mean_spend_phone", "expense_means"),
    141: ("mean_spend_rent", "expense_means"), 142: ("mean_spend_other", "expense_means"),
    144: ("value", "select_household"), 147: ("heatmap_title", "select_household"),
    156: ("max_housing_problem", "dominant_problem"), 157: ("dominant_problem", "dominant_problem"),
    158: ("municipality_share", "share_of_total"), 159: ("pct_persons_municipality", "share_of_total"),
    160: ("pct_group", "share_in_subregion"), 161: ("bar_label", "group_bar_labels"),
    166: ("persons_in_selection", "share_of_selection"), 167: ("label_group_a", "share_of_selection"),
    168: ("label_group_b", "share_of_selection"), 169: ("label_group_c", "share_of_selection"),
    170: ("label_group_d", "share_of_selection"), 171: ("Subregion", "subregion_options"),
    172: ("coverage_rate", "coverage_latest"), 173: ("title", "dashboard_title"),
    176: ("persons_to_verify", "quality_categories"), 177: ("persons_excluded", "quality_categories"),
    181: ("valid_rank", "rank_quality"), 184: ("office_rank", "rank_quality"),
    187: ("coordinator_rank", "rank_quality"), 188: ("bar_label_by_group", "labels_and_titles"),
    189: ("pct_mpi_persons_municipality", "share_of_total"), 190: ("selected_year_text", "labels_and_titles"),
    191: ("mpi_card", "labels_and_titles"), 192: ("value", "select_sanitary"),
    193: ("value", "select_material"), 194: ("type_filter", "select_material"),
    195: ("value", "select_event"), 196: ("value, category_mean", "select_indicator"),
    197: ("value_pct", "select_household"), 198: ("value_spend", "select_household"),
    199: ("value", "select_deprivation"), 200: ("value", "select_event_means"),
    201: ("household_coverage", "coverage_households"), 202: ("axis_value", "select_axis"),
    203: ("population_coverage", "coverage_population"), 204: ("value", "select_service"),
    205: ("dwelling_coverage", "coverage_dwellings"),
}
