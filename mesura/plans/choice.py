"""Selector measures under a choice of labels (M13, rule B9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from mesura import schemas as S


def one(branches: Mapping[str, Column], chosen: Sequence[str]) -> Column:
    """The chosen label's branch. The branch is a variable that is evaluated
    once, outside the iteration over labels: several labels give BLANK, and so
    does a label without a branch."""
    if len(chosen) != 1 or chosen[0] not in branches:
        return F.lit(None).cast("double")
    return branches[chosen[0]].cast("double")


def mean(branches: Mapping[str, Column], chosen: Sequence[str]) -> Column:
    """The chosen label's branch, or the mean over several chosen labels; a
    BLANK branch does not count."""
    values = [branches[c].cast("double") for c in chosen if c in branches]
    if not values:
        return F.lit(None).cast("double")
    total = reduce(lambda a, b: a + b, [F.coalesce(v, F.lit(0.0)) for v in values])
    return total / F.nullif(reduce(lambda a, b: a + b, [v.isNotNull().cast("int") for v in values]), F.lit(0))


def indicator_title(categories: Sequence[str]) -> str:
    """Heat-map title: the visible categories, or all."""
    return S.TXT_MPI_HEATMAP + (", ".join(dict.fromkeys(categories)) or S.TXT_ALL_CATEGORIES)


def household_title(categories: Sequence[str]) -> str:
    """Heat-map title: the one visible category, else all."""
    seen = list(dict.fromkeys(categories))
    return S.TXT_HOUSEHOLD_HEATMAP + (seen[0] if len(seen) == 1 else S.TXT_ALL)


def year_title(years: Sequence[int]) -> str:
    """The selected year; nothing behind the text when several are visible."""
    seen = list(dict.fromkeys(years))
    return S.TXT_SELECTED_YEAR + (str(seen[0]) if len(seen) == 1 else "")
