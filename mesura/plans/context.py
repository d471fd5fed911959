"""Filter context: column -> predicate, applied as DataFrame filters.

A measure's own filter on a column *replaces* the context's filter on that
column (it does not intersect); context-removal measures evaluate their
denominator under the same context minus some columns. Both need to know
which columns a context touches, hence a mapping rather than one Column.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class FilterContext:
    def __init__(self, filters: dict[str, Column] | None = None):
        self._f: dict[str, Column] = dict(filters or {})

    @classmethod
    def latest(cls, fact: DataFrame, column: str = "anio") -> "FilterContext":
        """The greatest year of ``fact``, as a scalar subquery: a table
        partitioned by year reads that year's files only."""
        return cls({column: F.col(f"`{column}`") == fact.agg(F.max(f"`{column}`")).scalar()})

    @classmethod
    def of(cls, **values) -> "FilterContext":
        """Equality / membership filters: ``of(anio=2000, Subregion=["ASIA"])``."""
        f = {}
        for k, v in values.items():
            c = F.col(f"`{k}`")
            f[k] = c.isin(*v) if isinstance(v, (list, tuple, set)) else (c == F.lit(v))
        return cls(f)

    def columns(self) -> set[str]:
        return set(self._f)

    def with_filter(self, column: str, pred: Column) -> "FilterContext":
        f = dict(self._f)
        f[column] = pred
        return FilterContext(f)

    def without(self, cols: Iterable[str]) -> "FilterContext":
        drop = set(cols)
        return FilterContext({k: v for k, v in self._f.items() if k not in drop})

    def keep_only(self, cols: Iterable[str]) -> "FilterContext":
        keep = set(cols)
        return FilterContext({k: v for k, v in self._f.items() if k in keep})

    def apply(self, df: DataFrame) -> DataFrame:
        for p in self._f.values():
            df = df.filter(p)
        return df

    def __bool__(self) -> bool:
        return bool(self._f)
