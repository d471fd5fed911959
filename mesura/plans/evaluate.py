"""Fused evaluation of measures under a filter context and group keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mesura.plans.context import FilterContext
from mesura.plans.measures import BASES, MEASURES


def q(name: str) -> Column:
    return F.col(f"`{name}`")


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Null-safe equi-join on ``keys`` (BLANK is a member like any other).

    With no keys the right side is a one-row aggregate; it is joined on a
    constant key (an equi-join of a single row, planned as a broadcast).
    """
    if not keys:
        lk = left.withColumn("__k", F.lit(0))
        rk = right.withColumn("__k", F.lit(0))
        return lk.join(rk, "__k", how).drop("__k")
    r = right
    renamed = {k: f"__r_{i}" for i, k in enumerate(keys)}
    for k, nk in renamed.items():
        r = r.withColumnRenamed(k, nk)
    cond = reduce(lambda a, b: a & b, [q(k).eqNullSafe(q(nk)) for k, nk in renamed.items()])
    out = left.join(r, cond, how)
    if how == "full_outer":
        out = out.withColumns({k: F.coalesce(q(k), q(nk)) for k, nk in renamed.items()})
    return out.drop(*renamed.values())


def evaluate(fact: DataFrame, keys: Sequence[str], names: Sequence[str],
             ctx: FilterContext | None = None, keep_bases: bool = False) -> DataFrame:
    """One row per key combination present in the filtered fact, one column
    per measure.

    All bases that no filter replacement affects are computed in a single
    ``groupBy(keys).agg(...)`` (one scan, one shuffle of partial aggregates).
    A base whose own predicate column is a group key or an outer filter
    (rule B12) is evaluated again with that key and filter removed, grouped by
    the remaining keys, and joined back. Where only a filter was removed the
    join is full: a member whose rows the filter hides altogether still shows
    the measures that replace it. Where a key was removed its members are
    those of the filtered fact.
    """
    keys = list(keys)
    ctx = ctx or FilterContext()
    ms = [MEASURES[n] for n in names]
    need: list[str] = []
    for m in ms:
        for b in m.needs:
            if b not in need:
                need.append(b)
    touched = set(keys) | ctx.columns()
    groups: dict[frozenset, list[str]] = {frozenset(): []}
    for b in need:
        removed = frozenset(BASES[b].filter_cols) & touched
        groups.setdefault(removed, []).append(b)

    main = [BASES[b].make().alias(b) for b in groups[frozenset()]] or [F.count(F.lit(1)).alias("__rows")]
    out = ctx.apply(fact).groupBy(*[q(k) for k in keys]).agg(*main)
    for removed, bases in groups.items():
        if not removed:
            continue
        rest = [k for k in keys if k not in removed]
        side = (ctx.without(removed).apply(fact).groupBy(*[q(k) for k in rest])
                .agg(*[BASES[b].make().alias(b) for b in bases]))
        out = join_on_keys(out, side, rest, "left" if len(rest) < len(keys) or not keys else "full_outer")

    cols = [q(k) for k in keys] + [m.value(q).alias(m.name) for m in ms]
    if keep_bases:
        cols += [q(b) for b in need if b not in names]
    return out.select(*cols)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (ratios) so that engines agree to the digit."""
    return df.select(*[F.round(q(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else q(f.name) for f in df.schema.fields])
