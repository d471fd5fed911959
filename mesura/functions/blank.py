"""BLANK semantics of the measure language expressed as Spark Columns.

* counting no rows gives BLANK (null), not 0                       -> blank_count
* DIVIDE(a, b): BLANK when b is 0 or BLANK                          -> div
* DIVIDE(a, b, 0): 0 when b is 0 or BLANK, BLANK numerator stays    -> div0
* a - b treats BLANK as 0, but BLANK - BLANK is BLANK                -> blank_sub
* single-value pick is BLANK when several values are visible        -> selected_value
* distinct count counts BLANK as one value                          -> distinct_count_with_blank
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_count(pred: Column | None = None) -> Column:
    """COUNTROWS under a predicate: null instead of 0."""
    c = F.count(F.lit(1)) if pred is None else F.count_if(pred)
    return F.nullif(c, F.lit(0))


def div(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), F.nullif(b, F.lit(0)).cast("double"))


def div0(a: Column, b: Column) -> Column:
    return (F.when(F.coalesce(b, F.lit(0)) == 0, F.lit(0.0))
             .otherwise(F.try_divide(a.cast("double"), b.cast("double"))))


def blank_sub(a: Column, b: Column) -> Column:
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
        F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)))


def pct1(x: Column) -> Column:
    """FORMAT(x, "0.0%")."""
    return F.concat(F.format_number(x * 100, 1), F.lit("%"))


def selected_value(c: Column) -> Column:
    """SELECTEDVALUE: the one distinct value, else null (aggregate)."""
    return F.when(F.min(c) == F.max(c), F.max(c))


def distinct_count_with_blank(c: Column) -> Column:
    """DISTINCTCOUNT counts BLANK as a value of its own (aggregate)."""
    return F.count_distinct(c) + F.max(F.when(c.isNull(), 1).otherwise(0))
