"""Measures that change the filter context, under any keys and any context.

``ask`` takes names of plain measures (``plans.measures``) and of the ones
here: shares of a total with filters removed, ranks among all members,
accumulation, rank-1 picks, year on year. What a measure removes from the
context is evaluated without those filters in a second aggregate; where the
context has none of them, a window over the first aggregate is enough.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mesura import schemas as S
from mesura.functions.blank import blank_sub, div, div0
from mesura.plans.analytics import dense_rank_of, pareto, total_over
from mesura.plans.context import FilterContext
from mesura.plans.evaluate import evaluate, join_on_keys, q
from mesura.plans.measures import MEASURES

TERRITORY = frozenset(S.TERRITORY_COLUMNS)


def _over(names: Sequence[str]):
    return Window.partitionBy(*map(q, names)) if names else Window.partitionBy(F.lit(0))


@dataclass(frozen=True)
class Share:
    """``measure`` over itself with the filters on ``removes`` taken away, or,
    if ``keeps`` is given, with all filters but those."""

    ref: int
    measure: str
    removes: frozenset[str] = frozenset()
    keeps: frozenset[str] | None = None
    total: bool = False  # the total itself, not the share

    def add(self, out: DataFrame, name: str, fact: DataFrame, keys: list[str], ctx: FilterContext) -> DataFrame:
        touched = set(keys) | ctx.columns()
        removed = touched - self.keeps if self.keeps is not None else touched & self.removes
        rest = [k for k in keys if k not in removed]
        if ctx.columns() & removed:
            side = evaluate(fact, rest, [self.measure], ctx.without(removed)).withColumnRenamed(self.measure, "__total")
            out = join_on_keys(out, side, rest)
        else:
            out = out.withColumn("__total", total_over(q(self.measure), rest))
        value = q("__total") if self.total else div(q(self.measure), q("__total"))
        return out.withColumn(name, value).drop("__total")

    @property
    def needs(self) -> tuple[str, ...]:
        return (self.measure,)


def _members(fact: DataFrame, keys: list[str], entity: str, removed: frozenset[str], names: Sequence[str], ctx: FilterContext) -> DataFrame:
    """The measures of all members of ``entity``, with the filters on
    ``removed`` taken away."""
    if entity not in keys:
        raise ValueError(f"the measure compares members of {entity}; group by it")
    return evaluate(fact, keys, names, ctx.without(removed))


@dataclass(frozen=True)
class Rank:
    """Dense rank among all municipalities. ``blank``: a BLANK value has a
    BLANK rank instead of the rank of 0."""

    ref: int
    measure: str
    blank: bool = False
    descending: bool = True
    entity: str = "Municipio"

    def add(self, out: DataFrame, name: str, fact: DataFrame, keys: list[str], ctx: FilterContext) -> DataFrame:
        rows = _members(fact, keys, self.entity, frozenset({self.entity}), [self.measure], ctx)
        rank = dense_rank_of(q(self.measure), [k for k in keys if k != self.entity], self.descending)
        rank = F.when(q(self.measure).isNotNull(), rank) if self.blank else rank
        return join_on_keys(out, rows.select(*map(q, keys), rank.alias(name)), keys)

    @property
    def needs(self) -> tuple[str, ...]:
        return (self.measure,)


@dataclass(frozen=True)
class Accumulated:
    """Sum over the municipalities that are not below this one, all territory
    filters removed; ``share`` of their total."""

    ref: int
    measure: str
    share: bool = False
    entity: str = "Municipio"

    def add(self, out: DataFrame, name: str, fact: DataFrame, keys: list[str], ctx: FilterContext) -> DataFrame:
        rows = _members(fact, keys, self.entity, TERRITORY, [self.measure], ctx)
        cumulative, share = pareto(q(self.measure), [k for k in keys if k not in TERRITORY])
        return join_on_keys(out, rows.select(*map(q, keys), (share if self.share else cumulative).alias(name)), keys)

    @property
    def needs(self) -> tuple[str, ...]:
        return (self.measure,)


@dataclass(frozen=True)
class Pick:
    """Something about the members of ``entity`` at rank 1 by ``by``, for keys
    without the entity. ``make`` gets the mark of those members."""

    ref: int
    by: str
    also: tuple[str, ...]
    make: Callable[[Column], Column]
    entity: str = "Municipio"
    needs: tuple[str, ...] = ()

    def add(self, out: DataFrame, name: str, fact: DataFrame, keys: list[str], ctx: FilterContext) -> DataFrame:
        if self.entity in keys:
            raise ValueError(f"the measure picks a member of {self.entity}; do not group by it")
        rows = evaluate(fact, [*keys, self.entity], [self.by, *self.also], ctx.without({self.entity}))
        rows = rows.withColumn("__first", dense_rank_of(q(self.by), keys) == 1)
        return join_on_keys(out, rows.groupBy(*map(q, keys)).agg(self.make(q("__first")).alias(name)), keys)


@dataclass(frozen=True)
class YearOnYear:
    """The rate at the latest year in context, at the year before, or their
    change, for keys without the year."""

    ref: int
    part: str
    needs: tuple[str, ...] = ()

    def add(self, out: DataFrame, name: str, fact: DataFrame, keys: list[str], ctx: FilterContext) -> DataFrame:
        rest = [k for k in keys if k != "anio"]
        rows = evaluate(fact, [*rest, "anio"], ["persons", "mpi_persons"], ctx)
        latest = rows.groupBy(*map(q, rest)).agg(F.max("anio").alias("__latest"))
        # the year before is looked up without the year's filter
        both = evaluate(fact, [*rest, "anio"], ["persons", "mpi_persons"], ctx.without({"anio"}))
        both = join_on_keys(both, latest, rest, "inner")
        at = lambda year: div0(F.sum(F.when(q("anio") == year, q("mpi_persons"))), F.sum(F.when(q("anio") == year, q("persons"))))
        now, before = at(q("__latest")), at(q("__latest") - 1)
        value = {"current": now, "previous": before, "change": blank_sub(now, before)}[self.part]
        return join_on_keys(out, both.groupBy(*map(q, rest)).agg(value.alias(name)), rest)


def _only(first: Column) -> Column:
    return F.when(F.count_if(first) == 1, F.max(F.when(first, q("Municipio"))))


def _sum(first: Column, name: str) -> Column:
    return F.sum(F.when(first, q(name)))


ANALYTIC: dict[str, Share | Rank | Accumulated | Pick | YearOnYear] = {
    "mpi_rank": Rank(19, "mpi_rate"),
    "top_mpi_rate": Pick(20, "mpi_rate", ("persons", "mpi_persons"), lambda x: div0(_sum(x, "mpi_persons"), _sum(x, "persons"))),
    "top_mpi_municipality": Pick(21, "mpi_rate", (), _only),
    "mpi_rate_current_year": YearOnYear(24, "current"),
    "mpi_rate_previous_year": YearOnYear(25, "previous"),
    "mpi_change": YearOnYear(26, "change"),
    "mpi_persons_rank": Rank(35, "mpi_persons"),
    "top_mpi_persons_municipality": Pick(36, "mpi_persons", (), _only),
    "top_mpi_persons": Pick(37, "mpi_persons", (), lambda x: _sum(x, "mpi_persons")),
    "mpi_share": Share(38, "mpi_persons", TERRITORY),
    "mpi_cumulative": Accumulated(39, "mpi_persons"),
    "mpi_cumulative_pct": Accumulated(40, "mpi_persons", share=True),
    "top_mpi_share": Pick(42, "mpi_persons", (), lambda x: div(_sum(x, "mpi_persons"), F.sum("mpi_persons"))),
    "volume_rank": Rank(43, "mpi_persons"),
    "largest_volume_municipality": Pick(44, "mpi_persons", (), lambda x: F.max(F.when(x, q("Municipio")))),
    "leader_share": Pick(45, "mpi_persons", (), lambda x: div(_sum(x, "mpi_persons"), F.sum("mpi_persons"))),
    "top_incidence_subregion": Pick(47, "incidence", (), lambda x: F.array_join(F.array_sort(F.collect_list(F.when(x, q("Subregion")))), ", "), entity="Subregion"),
    "mpi_share_in_subregion": Share(48, "mpi_persons", TERRITORY - {"Subregion"}),
    "mpi_share_in_subregion_all_groups": Share(49, "mpi_persons", (TERRITORY - {"Subregion"}) | {"grupo_sisben"}),
    "mpi_share_in_subregion_selection": Share(50, "mpi_persons", frozenset({"grupo_sisben", "Municipio"})),
    "dwellings_over_subregion": Share(82, "dwellings", keeps=frozenset({"Subregion"})),
    "municipality_share": Share(158, "persons", frozenset({"cod_mpio"})),
    "pct_persons_municipality": Share(159, "persons", frozenset({"cod_mpio"})),
    "pct_group": Share(160, "persons", frozenset({"grupo_sisben"})),
    "persons_in_subregion": Share(166, "persons", TERRITORY - {"Subregion"}, total=True),
    "valid_rank": Rank(181, "valid_pct", blank=True),
    "office_rank": Rank(184, "office_pct", blank=True),
    "coordinator_rank": Rank(187, "coordinator_pct", blank=True),
    "pct_mpi_persons_municipality": Share(189, "mpi_persons", frozenset({"cod_mpio"})),
}


def ask(fact: DataFrame, keys: Sequence[str], names: Sequence[str], ctx: FilterContext | None = None) -> DataFrame:
    """One row for each key combination of the filtered fact, one column for
    each measure of ``names``, plain or analytic."""
    keys, ctx = list(keys), ctx or FilterContext()
    plain = [n for n in names if n not in ANALYTIC]
    needed = list(dict.fromkeys([*plain, *(m for n in names if n in ANALYTIC for m in ANALYTIC[n].needs)])) or ["persons"]
    out = evaluate(fact, keys, needed, ctx)
    for n in names:
        if n in ANALYTIC:
            out = ANALYTIC[n].add(out, n, fact, keys, ctx)
    return out.select(*map(q, keys), *map(q, names))


def refs() -> set[int]:
    return {m.ref for m in MEASURES.values()} | {m.ref for m in ANALYTIC.values()}
