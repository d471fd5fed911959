"""Measures at several grains at once: grouping sets over one scan.

Totals are evaluated, not added up: a mean, a ratio or a distinct count of a
coarser set comes from its own rows. A base whose own filter replaces a key or
a filter (rule B12) is evaluated once more for all sets without that column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mesura.plans.context import FilterContext
from mesura.plans.evaluate import join_on_keys, q
from mesura.plans.measures import BASES, MEASURES


def total_mark(key: str) -> str:
    """The column that tells a subtotal over ``key`` from the member null."""
    return f"{key}_total"


def _number(names: Sequence[str], kept: Sequence[str]) -> int:
    """``grouping_id`` of the set ``kept`` among ``names``."""
    return sum(1 << (len(names) - 1 - k) for k, n in enumerate(names) if n not in kept)


def evaluate_sets(fact: DataFrame, sets: Sequence[Sequence[str]], names: Sequence[str], ctx: FilterContext | None = None) -> DataFrame:
    """One row for each member of each of the key ``sets``: the keys (null
    where the set has not the key), a mark ``<key>_total`` for each key, and
    the measures as ``plans.evaluate.evaluate`` gives them for that set."""
    ctx = ctx or FilterContext()
    keys = list(dict.fromkeys(k for s in sets for k in s))
    ms = [MEASURES[n] for n in names]
    groups: dict[frozenset, list[str]] = {frozenset(): []}
    for b in dict.fromkeys(b for m in ms for b in m.needs):
        groups.setdefault(frozenset(BASES[b].filter_cols) & (set(keys) | ctx.columns()), []).append(b)

    def grouped(rows: DataFrame, own: Sequence[Sequence[str]], names: Sequence[str], bases: Sequence[str]) -> DataFrame:
        made = [BASES[b].make().alias(b) for b in bases] or [F.count(F.lit(1)).alias("__rows")]
        if not names:
            return rows.agg(*made).withColumn("__set", F.lit(0).cast("long"))
        distinct = list(dict.fromkeys(tuple(s) for s in own))
        return rows.groupingSets([[q(k) for k in s] for s in distinct], *map(q, names)).agg(*made, F.grouping_id().alias("__set"))

    out = grouped(ctx.apply(fact), sets, keys, groups[frozenset()])
    for removed, bases in groups.items():
        if not removed:
            continue
        rest = [k for k in keys if k not in removed]
        reduced = [[k for k in s if k not in removed] for s in sets]
        side = grouped(ctx.without(removed).apply(fact), reduced, rest, bases).withColumnRenamed("__set", "__side")
        told = F.create_map(*[F.lit(x).cast("long") for s, r in zip(sets, reduced) for x in (_number(keys, s), _number(rest, r))])
        if len(rest) == len(keys):  # a filter alone was removed: members it hides show the measures that replace it
            out = join_on_keys(out, side.withColumnRenamed("__side", "__set"), [*keys, "__set"], "full_outer")
        else:
            out = join_on_keys(out.withColumn("__side", told[q("__set")]), side, [*rest, "__side"]).drop("__side")
    marks = [(F.shiftright("__set", len(keys) - 1 - k) % 2 == 1).alias(total_mark(key)) for k, key in enumerate(keys)]
    return out.select(*map(q, keys), *marks, *[m.value(q).alias(m.name) for m in ms])
