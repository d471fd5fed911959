"""The enriched survey fact as one SQL common table expression.

Used by the DuckDB oracle of ``__spark_entry__.oracle_sql``: the base view is
the shared fixture text (mesura.sources.survey); the derived columns are
written here a second time, in SQL, independently of the DataFrame code in
mesura.operators.derive.
"""

from __future__ import annotations

from mesura import schemas as S
from mesura.sources.survey import VIEW_FROM_SQL, view_select_sql


def lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def case(col: str, mapping: dict, default: str | None = S.UNKNOWN) -> str:
    arms = " ".join(f"WHEN {col} = {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    tail = f" ELSE {lit(default)}" if default is not None else ""
    return f"CASE {arms}{tail} END"


def age_band_sql(col: str, missing: str | None = None) -> str:
    arms = [f"WHEN {col} IS NULL THEN {lit(missing) if missing is not None else 'NULL'}"]
    for upper, text in S.AGE_BANDS:
        arms.append(f"WHEN {col} <= {upper} THEN {lit(text)}" if upper is not None else f"ELSE {lit(text)}")
    return "CASE " + " ".join(arms) + " END"


def age_order_sql(col: str) -> str:
    arms = [f"WHEN {col} IS NULL THEN NULL"]
    for i, (upper, _) in enumerate(S.AGE_BANDS, start=1):
        arms.append(f"WHEN {col} <= {upper} THEN {i}" if upper is not None else f"ELSE {i}")
    return "CAST(CASE " + " ".join(arms) + " END AS BIGINT)"


def derived_sql() -> str:
    priv = "(" + " + ".join(f"coalesce(I{k}, 0)" for k in range(11, 16)) + ")"
    free, moderate, high = S.HOUSING_QUALITY
    ppr = "(CAST(num_personas_hogar AS DOUBLE) / CAST(nullif(num_cuartos_vivienda, 0) AS DOUBLE))"
    sexhead = "(CASE WHEN tip_parentesco = 1 THEN sexo_persona END)"
    parts = [
        ("orden_clasificacion",
         "CAST(CASE substring(Clasificacion, 1, 1) WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 3 "
         "WHEN 'D' THEN 4 ELSE 99 END AS BIGINT)"),
        ("Tipo_Vivienda_txt", case("tip_vivienda", S.DWELLING_TYPE)),
        ("Material de las Paredes", case("tip_mat_paredes", S.WALL_MATERIAL)),
        ("Energia_txt", case("ind_tiene_energia", S.SERVICE)),
        ("Acueducto_txt", case("ind_tiene_acueducto", S.SERVICE)),
        ("Alcantarillado_txt", case("ind_tiene_alcantarillado", S.SERVICE)),
        ("Gas_txt", case("ind_tiene_gas", S.SERVICE)),
        ("Recoleccion_txt", case("ind_tiene_recoleccion", S.SERVICE)),
        ("Clase_txt", case("Cod_clase", S.AREA_CLASS)),
        ("Sanitario_txt", case("tip_sanitario", S.SANITARY)),
        ("Privaciones_Vivienda", f"CAST({priv} AS BIGINT)"),
        ("Nivel_Calidad_Vivienda",
         f"CASE WHEN {priv} = 0 THEN {lit(free)} WHEN {priv} <= 2 THEN {lit(moderate)} "
         f"WHEN {priv} >= 3 THEN {lit(high)} ELSE {lit(S.UNKNOWN)} END"),
        ("Zona", case("Cod_clase", S.AREA_CLASS)),
        ("Es_Jefe", "CAST(tip_parentesco = 1 AS BIGINT)"),
        ("Sexo_Jefe", f"CAST({sexhead} AS BIGINT)"),
        ("Sexo_Jefe_Label", case(sexhead, S.HEAD_SEX, None)),
        ("Personas_por_Cuarto", ppr),
        ("Cat_Hacinamiento", f"CASE WHEN {ppr} IS NULL THEN {lit(S.UNKNOWN)} WHEN {ppr} > 3 "
                             f"THEN {lit(S.CROWDED)} ELSE {lit(S.NOT_CROWDED)} END"),
        ("Material del Piso", case("tip_mat_pisos", S.FLOOR_MATERIAL)),
        ("Orden_Paredes", "CAST(tip_mat_paredes AS BIGINT)"),
        ("Tipo_Ocupacion_txt", case("tip_ocupa_vivienda", S.TENURE)),
        ("Rango_Edad", age_band_sql("Edad")),
        ("Orden_Edad", age_order_sql("Edad")),
        ("Regimen_Salud_Limpio", case("tip_seg_social", S.HEALTH_REGIME)),
    ]
    return ",\n  ".join(f'{x} AS "{n}"' for n, x in parts)


def fact_cte() -> str:
    return (f"WITH base AS (SELECT\n  {view_select_sql()}\nFROM {VIEW_FROM_SQL}),\n"
            f"fact AS (SELECT *,\n  {derived_sql()}\nFROM base)\n")


FACT = fact_cte()


def with_fact(body: str, *ctes: str) -> str:
    """``WITH base, fact[, more CTEs] <body>``."""
    extra = "".join(f", {c}\n" for c in ctes)
    return FACT.rstrip("\n") + "\n" + extra + body
