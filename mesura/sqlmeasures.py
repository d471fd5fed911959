"""SQL forms of the registry measures, for the DuckDB oracle.

Each entry is an aggregate SQL expression over the ``fact`` CTE of
mesura.sqlfact, evaluated per GROUP BY group.
"""

from __future__ import annotations

from mesura import schemas as S
from mesura.sqlfact import lit

HH = "tip_parentesco = 1"
DW = "tip_parentesco = 1 AND ide_hogar = 1"
MPI = "substring(trim(CAST(H_5 AS VARCHAR)), 1, 1) = '1'"


def cnt(cond: str | None = None) -> str:
    return "nullif(count(*),0)" if cond is None else f"nullif(count(*) FILTER (WHERE {cond}),0)"


def sdiv(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif({b},0))"


def sdiv0(a: str, b: str) -> str:
    return f"(CASE WHEN coalesce({b},0) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / {b} END)"


def bsub(a: str, b: str) -> str:
    return f"(CASE WHEN ({a}) IS NULL AND ({b}) IS NULL THEN NULL ELSE coalesce({a},0) - coalesce({b},0) END)"


def avg_if(cond: str, value: str) -> str:
    return f"avg(CASE WHEN {cond} THEN {value} END)"


def inlist(values) -> str:
    return ", ".join(lit(v) for v in values)


P = cnt()
DWC = cnt(DW)
HHC = cnt(HH)
SQL: dict[str, str] = {
    "poor_households": cnt(f"{HH} AND H_5 = 1"),
    "persons": P,
    "total_rows": "count(*)",
    "distinct_classes": "(count(DISTINCT orden_clasificacion) + "
                        "max(CASE WHEN orden_clasificacion IS NULL THEN 1 ELSE 0 END))",
    "mpi_persons": cnt(MPI),
    "mpi_rate": sdiv0(cnt(MPI), P),
    "poverty_persons": cnt("grupo_sisben IN ('A','B')"),
    "poverty_rate": sdiv0(cnt("grupo_sisben IN ('A','B')"), P),
    "poverty_incidence": sdiv0(cnt("grupo_sisben IN ('A','B')"), P),
    "max_year": "max(anio)",
    "min_age": "min(Edad)",
    "max_age": "max(Edad)",
    "mpi_incidence_department": sdiv(cnt(MPI), P),
    "incidence": sdiv(cnt(MPI), P),
    "dwellings": DWC,
    "households": HHC,
    "persons_per_household": sdiv(P, HHC),
    "household_size": sdiv(P, HHC),
    "dwellings_with_deprivation": cnt(f"{DW} AND Privaciones_Vivienda > 0"),
    "mean_housing_quality": avg_if("ide_hogar = 1", "CASE Nivel_Calidad_Vivienda " + " ".join(
        f"WHEN {lit(t)} THEN {i}" for i, t in enumerate(S.HOUSING_QUALITY)) + " END"),
    "household_deprivation_score": avg_if(HH, "Privaciones_Vivienda"),
    "mean_dwelling_deprivations": avg_if(DW, "Privaciones_Vivienda"),
    "mean_deprivations_rural": avg_if(f"{DW} AND Cod_clase = 3", "Privaciones_Vivienda"),
    "mean_deprivations_town": avg_if(f"{DW} AND Cod_clase IN (2, 3)", "Privaciones_Vivienda"),
    "dwellings_male_head": cnt(f"{DW} AND Sexo_Jefe = 1"),
    "dwellings_female_head": cnt(f"{DW} AND Sexo_Jefe = 2"),
    "mean_deprivations_male_head": avg_if(f"{DW} AND Sexo_Jefe = 1", "Privaciones_Vivienda"),
    "mean_deprivations_female_head": avg_if(f"{DW} AND Sexo_Jefe = 2", "Privaciones_Vivienda"),
    "deprivation_gap": bsub(avg_if(f"{DW} AND Sexo_Jefe = 2", "Privaciones_Vivienda"),
                            avg_if(f"{DW} AND Sexo_Jefe = 1", "Privaciones_Vivienda")),
    "households_male_head": cnt(f"{HH} AND Sexo_Jefe = 1"),
    "households_female_head": cnt(f"{HH} AND Sexo_Jefe = 2"),
    "mean_rooms": "avg(num_cuartos_vivienda)",
    "mean_households_per_dwelling": "avg(num_hogares_vivienda)",
    "mean_spend_total": avg_if(HH, "vlr_total_gastos"),
    "persons_per_bedroom": sdiv0(P, "sum(num_cuartos_dormir)"),
    "pct_hh_solid_fuel": sdiv0(cnt(f"{HH} AND tip_energia_cocina IN (4, 5, 6)"), HHC),
    "men_negative": f"-{cnt('sexo_persona = 1')}",
    "women": cnt("sexo_persona = 2"),
    "pct_men": sdiv(f"-{cnt('sexo_persona = 1')}", P),
    "pct_women": sdiv(cnt("sexo_persona = 2"), P),
    "men_pyramid": cnt("sexo_persona = 1"),
    "validated": cnt("estado = '0'"),
    "valid_pct": sdiv(cnt("estado = '0'"), P),
    "kpi_db_health": sdiv(sdiv(cnt("estado = '0'"), P), P),
    "integrity_pct": sdiv(sdiv(cnt("estado = '0'"), P), P),
    "office_checks": cnt(f"estado IN ({inlist(S.OFFICE_CHECK_STATES)})"),
    "office_pct": sdiv(cnt(f"estado IN ({inlist(S.OFFICE_CHECK_STATES)})"),
                       cnt("estado <> '0' AND estado IS NOT NULL")),
    "coordinator_checks": cnt(f"estado IN ({inlist(S.COORDINATOR_STATES)})"),
    "coordinator_pct": sdiv(cnt(f"estado IN ({inlist(S.COORDINATOR_STATES)})"),
                            cnt("estado <> '0' AND estado IS NOT NULL")),
}
for g in "ABCD":
    SQL[f"persons_{g.lower()}"] = cnt(f"grupo_sisben = '{g}'")
    SQL[f"group_{g.lower()}"] = cnt(f"grupo_sisben = '{g}'")
    SQL[f"pct_{g.lower()}"] = sdiv(cnt(f"grupo_sisben = '{g}'"), P)

_dw_share = {
    "pct_no_energy": "ind_tiene_energia = 2", "pct_no_water_supply": "ind_tiene_acueducto = 2",
    "pct_no_sewer": "ind_tiene_alcantarillado = 2", "pct_no_gas": "ind_tiene_gas = 2",
    "pct_no_waste_collection": "ind_tiene_recoleccion = 2",
    "pct_poor_floors": "tip_mat_pisos IN (4, 5, 6)", "pct_no_water": "I11 = 1",
    "pct_poor_walls": "tip_mat_paredes IN (3, 4, 5, 6, 7)",
    "pct_crowded": f"Cat_Hacinamiento = {lit(S.CROWDED)}", "pct_poor_sanitation": "I12 = 1",
    "pct_rural_dwellings": "Cod_clase = 3", "pct_dwellings_with_deprivation": "Privaciones_Vivienda >= 1",
    "pct_male_head": "Sexo_Jefe = 1", "pct_female_head": "Sexo_Jefe = 2",
    "pct_crowded_observed": "Personas_por_Cuarto > 3",
    "pct_multi_household_dwellings": "num_hogares_vivienda > 1",
    "pct_with_energy": "ind_tiene_energia = 1", "pct_with_water_supply": "ind_tiene_acueducto = 1",
    "pct_with_gas": "ind_tiene_gas = 1",
}
EVENT_SQL = [("flood", "inundacion", "num_evento_inundacion"),
             ("avalanche", "avalancha", "num_evento_avalancha"),
             ("earthquake", "terremoto", "num_evento_terremoto"),
             ("fire", "incendio", "num_evento_incendio"),
             ("windstorm", "vendaval", "Num_evento_vendaval"),
             ("subsidence", "hundimiento", "num_evento_hundimiento")]
for name, stem, _ in EVENT_SQL:
    _dw_share[f"pct_{name}"] = f"ind_evento_{stem} = 1"
for name, cond in _dw_share.items():
    SQL[name] = sdiv(cnt(f"{DW} AND {cond}"), DWC)
for name, stem, num in EVENT_SQL:
    SQL[f"mean_{name}s"] = SQL[f"selected_mean_{name}s"] = avg_if(f"ind_evento_{stem} = 1", num)
for k in range(1, 16):
    SQL[f"pct_i{k}"] = sdiv0(f"sum(I{k})", P)
_assets = {"internet": "ind_tiene_internet", "fridge": "ind_tiene_nevera", "washer": "ind_tiene_lavadora",
           "pc": "ind_tiene_pc", "motorbike": "ind_tiene_moto", "tractor": "ind_tiene_tractor",
           "car": "ind_tiene_carro", "property": "ind_tiene_bien_raiz", "kitchen": "ind_tiene_cocina",
           "water_7days": "ind_agua_llega_7dias", "water_24h": "ind_agua_llega_24horas"}
for name, c in _assets.items():
    SQL[f"pct_hh_{name}"] = sdiv0(cnt(f"{HH} AND {c} = 1"), HHC)
for name, stem in [("food", "alimento"), ("transport", "transporte"), ("education", "educacion"),
                   ("health", "salud"), ("utilities", "serv_publicos"), ("phone", "celular"),
                   ("rent", "arriendo"), ("other", "otros")]:
    SQL[f"pct_hh_spend_{name}"] = sdiv0(cnt(f"{HH} AND ind_gasto_{stem} = 1"), HHC)


def select_measures(keys: list[str], names: list[str], where: str | None = None) -> str:
    """SELECT keys, measures FROM fact [WHERE] GROUP BY keys."""
    def out(n):
        x = SQL[n]
        is_double = "DOUBLE" in x or "avg(" in x
        return f"round({x}, 6) AS {n}" if is_double else f"{x} AS {n}"
    cols = [f'"{k}"' for k in keys] + [out(n) for n in names]
    w = f" WHERE {where}" if where else ""
    g = f" GROUP BY {', '.join(chr(34) + k + chr(34) for k in keys)}" if keys else ""
    return f"SELECT {', '.join(cols)} FROM fact{w}{g}"
