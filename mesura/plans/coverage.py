"""Measures over two tables: the survey against its projections, under any
context.

A filter on a dimension reaches each side along the model's relationships
before the side is aggregated (``plans.star``): years and territory reach the
fact and every projection, the state reaches the fact alone, the age band the
population alone. Filters of the context on the year or a territory column are
filters on those dimensions; filters on the fact's own columns stay there.
Keys that a projection has no relationship to repeat its sum.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mesura import schemas as S
from mesura.functions.blank import div, div0
from mesura.plans import star
from mesura.plans.analytic import ANALYTIC, ask
from mesura.plans.context import FilterContext
from mesura.plans.evaluate import join_on_keys, q

#: Columns of the fact that stand for a dimension all tables are related to.
COMMON = ("anio", *S.TERRITORY_COLUMNS)


@dataclass(frozen=True)
class Model:
    """The fact, its projections (by table name of the relationships), the
    dimensions, and filters on dimensions."""

    fact: DataFrame
    projections: Mapping[str, DataFrame]
    dimensions: Mapping[str, DataFrame]
    filters: Mapping[str, Column] = field(default_factory=dict)

    def projection(self, table: str, ctx: FilterContext, but_year: bool) -> DataFrame:
        """Rows of a projection that the filters leave, with the territory's
        columns; ``but_year``: filters on the year taken away."""
        filters = {d: p for d, p in self.filters.items() if not (but_year and d == "years")}
        rows = star.filtered(self.projections[table], table, self.dimensions, filters)
        rows = star.with_dimension(rows, table, "territory", self.dimensions["territory"], ["Municipio", "Subregion"])
        reach = set(COMMON) - ({"anio"} if but_year else set())
        return ctx.keep_only(ctx.columns() & reach).apply(rows)


@dataclass(frozen=True)
class Coverage:
    """``measure`` of the fact over the sum of ``value`` of a projection.
    ``latest``: the projection of the latest year that the fact has in context,
    whatever the context's filter on the year; BLANK, not 0, without one."""

    ref: int
    measure: str
    table: str
    value: str
    latest: bool = False

    def add(self, out: DataFrame, name: str, model: Model, fact: DataFrame, keys: list[str], ctx: FilterContext) -> DataFrame:
        rows = model.projection(self.table, ctx, but_year=self.latest)
        own = [k for k in keys if k in COMMON]
        if not self.latest:
            sums = rows.groupBy(*map(q, own)).agg(F.sum(q(self.value)).alias("__projected"))
            out = join_on_keys(out, sums, own)
            return out.withColumn(name, div0(q(self.measure), q("__projected"))).drop("__projected")
        rest = [k for k in own if k != "anio"]
        years = ctx.apply(fact).groupBy(*map(q, keys)).agg(F.max("anio").alias("__latest"))
        sums = rows.groupBy(*map(q, rest), q("anio").alias("__latest")).agg(F.sum(q(self.value)).alias("__projected"))
        out = join_on_keys(join_on_keys(out, years, keys), sums, [*rest, "__latest"])
        return out.withColumn(name, div(q(self.measure), q("__projected"))).drop("__latest", "__projected")


COVERAGE: dict[str, Coverage] = {
    "coverage_rate": Coverage(172, "persons", "population", "Poblacion_Proyectada", latest=True),
    "household_coverage": Coverage(201, "households", "households", "Hogares_Proyectados"),
    "population_coverage": Coverage(203, "persons", "population", "Poblacion_Proyectada"),
    "dwelling_coverage": Coverage(205, "dwellings", "dwellings", "Viviendas_Proyectadas"),
}


def ask_model(model: Model, keys: Sequence[str], names: Sequence[str], ctx: FilterContext | None = None) -> DataFrame:
    """``plans.analytic.ask`` over a model: one row for each key combination of
    the filtered fact; ``names`` may also be measures over two tables."""
    keys, ctx = list(keys), ctx or FilterContext()
    fact = star.filtered(model.fact, "fact", model.dimensions, model.filters)
    plain = [n for n in names if n not in COVERAGE]
    needed = list(dict.fromkeys([*plain, *(COVERAGE[n].measure for n in names if n in COVERAGE)]))
    out = ask(fact, keys, needed, ctx)
    for n in names:
        if n in COVERAGE:
            out = COVERAGE[n].add(out, n, model, fact, keys, ctx)
    return out.select(*map(q, keys), *map(q, names))


def refs() -> set[int]:
    return {m.ref for m in ANALYTIC.values()} | {m.ref for m in COVERAGE.values()}
