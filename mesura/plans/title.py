"""The dashboard's title: what the filter context selects, in words."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mesura import schemas as S
from mesura.plans.context import FilterContext


def q(name: str) -> Column:
    return F.col(f"`{name}`")


def _seen(name: str) -> Column:
    """Visible values of a column that a filter bounds, in order."""
    return F.array_sort(F.collect_set(q(name).cast("string")))


def title(fact: DataFrame, values: Mapping[str, Sequence]) -> DataFrame:
    """One row ``title``. ``values`` maps a column to the values the filter
    keeps. The blocks are year, territory, area, group and class, sex of the
    head and ages; a block without a filter is left out, and a subregion is
    named when exactly one is visible."""
    ctx = FilterContext.of(**{k: list(v) for k, v in values.items()})
    on = set(values)
    names = [c for c in ("anio", "Subregion", "Municipio", "Zona", "grupo_sisben", "Clasificacion", "Sexo_Jefe_Label") if c in on]
    row = ctx.apply(fact).agg(*[_seen(c).alias(c) for c in names], F.min("Edad").alias("__low"), F.max("Edad").alias("__high"))
    none = F.lit(None).cast("string")
    said = lambda c: F.nullif(F.array_join(q(c), ", "), F.lit("")) if c in on else none
    # a filter that leaves no rows still names its block
    block = lambda word, c: F.concat(F.lit(word), F.coalesce(said(c), F.lit(""))) if c in on else none
    if "Subregion" in on:
        only = F.when(F.size("Subregion") == 1, F.element_at("Subregion", 1))
        known = F.create_map(*[x for t in S.SUBREGION_TITLES.items() for x in map(F.lit, t)])
        place = F.concat(F.lit("En "), F.coalesce(F.try_element_at(known, only), only))
    else:
        place = none
    pair = lambda a, b: F.nullif(F.concat_ws(", ", a, b), F.lit(""))
    ages = F.concat(F.lit("Edades "), F.coalesce(F.col("__low").cast("string"), F.lit("")), F.lit(" - "),
                    F.coalesce(F.col("__high").cast("string"), F.lit(""))) if "Edad" in on else none
    blocks = [block("Año ", "anio"), pair(place, said("Municipio")), block("Zona ", "Zona"), pair(block("Grupo ", "grupo_sisben"), said("Clasificacion")),
              F.array_join(F.transform(q("Sexo_Jefe_Label"), lambda x: F.concat(x, F.lit(" Hogar"))), ", ") if "Sexo_Jefe_Label" in on else none, ages]
    joined = F.concat_ws(" • ", *blocks)
    return row.select(F.when(joined == "", F.lit(S.TXT_OVERVIEW)).otherwise(F.concat(F.lit(S.TXT_SELECTION), joined)).alias("title"))
