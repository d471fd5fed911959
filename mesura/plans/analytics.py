"""Measures evaluated over the aggregated rows: windows, ranks, Pareto.

All windows here run on the output of ``evaluate`` (one row per group key
combination: municipalities x years, a few thousand rows even nationally),
never on fact rows, so an unpartitioned window holds a bounded row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mesura.functions.blank import div


def q(name: str) -> Column:
    return F.col(f"`{name}`")


def _window(partition: Sequence[str]):
    return Window.partitionBy(*[q(p) for p in partition]) if partition else Window.partitionBy(F.lit(0))


def dense_rank_of(value: Column, partition: Sequence[str], descending: bool = True,
                  blank_as_zero: bool = True) -> Column:
    """RANKX(..., DENSE): ties share a rank; BLANK ranks as 0 (rule B5)."""
    v = F.coalesce(value, F.lit(0)) if blank_as_zero else value
    order = v.desc() if descending else v.asc()
    return F.dense_rank().over(_window(partition).orderBy(order)).cast("long")


def total_over(value: Column, partition: Sequence[str]) -> Column:
    """Sum of a distributive base over the rows that share ``partition``."""
    return F.sum(value).over(_window(partition))


def share_over(value: Column, partition: Sequence[str]) -> Column:
    return div(value, total_over(value, partition))


def pareto(value: Column, partition: Sequence[str]) -> tuple[Column, Column]:
    """(cumulative, cumulative share): sum of the values >= the current one
    (peers included: a RANGE frame), null where the value is BLANK."""
    w = (_window(partition).orderBy(value.desc())
         .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    cum = F.when(value.isNotNull(), F.sum(value).over(w))
    return cum, div(cum, total_over(value, partition))

