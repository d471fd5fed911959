"""The model's relationships: dimension joins on demand, and dimension filters
that reach every table that is related to the dimension (J1, J2)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mesura import schemas as S

#: Columns whose values are compared as integers (text code against number).
INTEGER_KEYS = {("state", "Cod_Estado")}


def q(name: str) -> Column:
    return F.col(f"`{name}`")


def _link(table: str, dimension: str) -> tuple[str, str]:
    for t, column, d, key in S.RELATIONSHIPS:
        if (t, d) == (table, dimension):
            return column, key
    raise KeyError(f"{table} is not related to {dimension}")


def related(table: str) -> list[str]:
    """Dimensions that filter ``table``."""
    return [d for t, _, d, _ in S.RELATIONSHIPS if t == table]


def with_dimension(df: DataFrame, table: str, dimension: str, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with the dimension's ``columns``; a key the dimension has not
    gets nulls. The optimiser broadcasts a dimension it knows to be small."""
    column, key = _link(table, dimension)
    side = rows.select(q(key).alias("__key"), *[q(c) for c in columns])
    own = q(column).try_cast("int") if (dimension, key) in INTEGER_KEYS else q(column)
    return df.join(side, own == q("__key"), "left").drop("__key")


def filtered(df: DataFrame, table: str, dimensions: Mapping[str, DataFrame], filters: Mapping[str, Column]) -> DataFrame:
    """Rows of ``df`` whose keys remain in every filtered dimension that is
    related to ``table``; a filter on another dimension does not reach it."""
    for dimension, keep in filters.items():
        if dimension in related(table):
            column, key = _link(table, dimension)
            own = q(column).try_cast("int") if (dimension, key) in INTEGER_KEYS else q(column)
            left = dimensions[dimension].where(keep).select(q(key).alias("__key")).distinct()
            df = df.join(left, own == q("__key"), "left_semi")
    return df
