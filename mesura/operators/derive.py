"""Derived columns of the survey fact (D1-D24) and of the projection tables.

Every rule is row-local, so ``enrich`` adds no shuffle: it is one projection
inside the scan's whole-stage-codegen span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mesura import schemas as S
from mesura.functions.labels import age_band, age_order, label


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def class_order(clasificacion: Column) -> Column:
    """First letter A/B/C/D -> 1..4; anything else and null -> 99."""
    return label(F.substring(clasificacion, 1, 1), S.CLASS_ORDER, None) \
        .otherwise(F.lit(S.CLASS_ORDER_DEFAULT)).cast("long")


def housing_deprivations() -> Column:
    """I11 + ... + I15 with null as 0."""
    return sum((F.coalesce(_c(f"I{k}"), F.lit(0)) for k in range(11, 16)), F.lit(0)).cast("long")


def housing_quality(privations: Column) -> Column:
    """0 / at most 2 / at least 3 deprivations."""
    free, moderate, high = S.HOUSING_QUALITY
    return (F.when(privations == 0, free).when(privations <= 2, moderate)
             .when(privations >= 3, high).otherwise(S.UNKNOWN))


def persons_per_room() -> Column:
    """Persons / rooms, rooms 0 -> null."""
    return F.try_divide(_c("num_personas_hogar").cast("double"),
                        F.nullif(_c("num_cuartos_vivienda"), F.lit(0)).cast("double"))


def crowding(ppr: Column) -> Column:
    """D18."""
    return F.when(ppr.isNull(), S.UNKNOWN).when(ppr > 3, S.CROWDED).otherwise(S.NOT_CROWDED)


def derived_columns() -> dict[str, Column]:
    head = _c("tip_parentesco") == 1
    ppr = persons_per_room()
    priv = housing_deprivations()
    sex_head = F.when(head, _c("sexo_persona")).cast("long")
    return {
        "orden_clasificacion": class_order(_c("Clasificacion")),
        "Tipo_Vivienda_txt": label(_c("tip_vivienda"), S.DWELLING_TYPE),
        "Material de las Paredes": label(_c("tip_mat_paredes"), S.WALL_MATERIAL),
        "Energia_txt": label(_c("ind_tiene_energia"), S.SERVICE),
        "Acueducto_txt": label(_c("ind_tiene_acueducto"), S.SERVICE),
        "Alcantarillado_txt": label(_c("ind_tiene_alcantarillado"), S.SERVICE),
        "Gas_txt": label(_c("ind_tiene_gas"), S.SERVICE),
        "Recoleccion_txt": label(_c("ind_tiene_recoleccion"), S.SERVICE),
        "Clase_txt": label(_c("Cod_clase"), S.AREA_CLASS),
        "Sanitario_txt": label(_c("tip_sanitario"), S.SANITARY),
        "Privaciones_Vivienda": priv,
        "Nivel_Calidad_Vivienda": housing_quality(priv),
        "Zona": label(_c("Cod_clase"), S.AREA_CLASS),
        "Es_Jefe": head.cast("long"),
        "Sexo_Jefe": sex_head,
        "Sexo_Jefe_Label": label(sex_head, S.HEAD_SEX, None),
        "Personas_por_Cuarto": ppr,
        "Cat_Hacinamiento": crowding(ppr),
        "Material del Piso": label(_c("tip_mat_pisos"), S.FLOOR_MATERIAL),
        "Orden_Paredes": _c("tip_mat_paredes").cast("long"),
        "Tipo_Ocupacion_txt": label(_c("tip_ocupa_vivienda"), S.TENURE),
        "Rango_Edad": age_band(_c("Edad")),
        "Orden_Edad": age_order(_c("Edad")),
        "Regimen_Salud_Limpio": label(_c("tip_seg_social"), S.HEALTH_REGIME),
    }


def enrich(df: DataFrame) -> DataFrame:
    """Base columns first (those that are derived are replaced), then the 24
    derived columns in their fixed order."""
    derived = derived_columns()
    base = [c for c in df.columns if c not in derived]
    return df.select(*[_c(c) for c in base],
                     *[derived[n].alias(n) for n in S.DERIVED_COLUMNS])
