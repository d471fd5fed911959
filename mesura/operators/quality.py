"""Data-quality audits: cross-tab counts (A2), schema conformance (Q1), the
data-state audit against the state dimension (Q2, J2) and row rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mesura.sources.literals import state_dim


def q(name: str):
    return F.col(f"`{name}`")


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """A2: counts by (a, b) with null keys kept as their own group."""
    return df.groupBy(q(a), q(b)).agg(F.count(F.lit(1)).alias("records"))


def crosstab_wide(df: DataFrame, a: str, b: str, values: Sequence[str], other: str = "other") -> DataFrame:
    """A2 wide form: one column per listed value of ``b`` (explicit values: no
    extra job to discover them) and column ``other`` for all other values and
    null, so that every row is counted."""
    some = F.nullif(F.count_if(~F.coalesce(q(b).isin(*values), F.lit(False))), F.lit(0))
    return df.groupBy(q(a)).agg(*[F.nullif(F.count_if(q(b) == v), F.lit(0)).alias(v) for v in values], some.alias(other))


def schema_conformance(spark: SparkSession, expected: Sequence[str], path: str) -> DataFrame:
    """Q1: a declared list of columns against the schema of the Parquet table
    at ``path``.

    status = "ok" (exact), "case" (differs in case only), "missing" (not in
    the file) or "extra" (in the file, not expected, ignoring case). Both
    sides are column-name lists (driver-sized by nature: a schema).
    """
    actual = spark.read.parquet(path).columns
    sch = T.StructType([T.StructField("name", T.StringType())])
    e = spark.createDataFrame([(n,) for n in expected], sch).withColumn("k", F.lower("name"))
    a = spark.createDataFrame([(n,) for n in actual], sch).withColumn("k", F.lower("name"))
    j = e.alias("e").join(a.alias("a"), F.col("e.k") == F.col("a.k"), "full_outer")
    status = (F.when(F.col("e.name").isNull(), "extra").when(F.col("a.name").isNull(), "missing")
               .when(F.col("e.name") == F.col("a.name"), "ok").otherwise("case"))
    return j.select(F.col("e.name").alias("expected"), F.col("a.name").alias("actual"), status.alias("status"))


def with_state(fact: DataFrame, spark: SparkSession) -> DataFrame:
    """Text state code joined to the integer-coded state dimension; a
    code absent from the dimension gets a null category."""
    dim = state_dim(spark)
    return fact.join(dim, q("estado").try_cast("int") == q("Cod_Estado"), "left")


def quality_categories(fact: DataFrame, spark: SparkSession, keys: Sequence[str]) -> DataFrame:
    """Q2: persons by macro category (valid / to verify / excluded)."""
    j = with_state(fact, spark)
    cat = q("Categoria_Macro")
    return j.groupBy(*[q(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("persons"),
        F.nullif(F.count_if(cat == "Válido"), F.lit(0)).alias("persons_valid"),
        F.nullif(F.count_if(cat == "Verificación"), F.lit(0)).alias("persons_to_verify"),
        F.nullif(F.count_if(cat == "Excluido"), F.lit(0)).alias("persons_excluded"),
        F.nullif(F.count_if(cat.isNull()), F.lit(0)).alias("persons_unknown_state"))


@dataclass(frozen=True)
class RowRule:
    """A row breaks the rule where ``broken`` is true; where it is null (a
    value it compares is missing) the row is not checked. ``kind`` is missing,
    range, code, cross (columns against each other) or key (a dimension has
    not the key)."""

    name: str
    kind: str
    broken: Column


def survey_rules() -> tuple[RowRule, ...]:
    """The survey's rules; those on keys need ``with_known_keys``."""
    return (
        RowRule("age_missing", "missing", q("Edad").isNull()),
        RowRule("group_missing", "missing", q("grupo_sisben").isNull()),
        RowRule("state_missing", "missing", q("estado").isNull()),
        RowRule("age_out_of_range", "range", ~q("Edad").between(0, 97)),
        RowRule("spending_negative", "range", q("vlr_total_gastos") < 0),
        RowRule("rooms_out_of_range", "range", ~q("num_cuartos_vivienda").between(1, 20)),
        RowRule("sex_code", "code", ~q("sexo_persona").isin(1, 2)),
        RowRule("area_code", "code", ~q("Cod_clase").isin(1, 2, 3)),
        RowRule("state_not_numeric", "code", q("estado").isNotNull() & q("estado").try_cast("int").isNull()),
        RowRule("head_under_age", "cross", (q("tip_parentesco") == 1) & (q("Edad") < 15)),
        RowRule("more_bedrooms_than_rooms", "cross", q("num_cuartos_dormir") > q("num_cuartos_vivienda")),
        RowRule("more_events_than_flagged", "cross", (q("ind_evento_inundacion") == 2) & (q("num_evento_inundacion") > 0)),
        RowRule("group_against_class", "cross", q("grupo_sisben") != F.substring(q("Clasificacion"), 1, 1)),
        RowRule("state_unknown", "key", q("estado").isNotNull() & q("__state").isNull()),
        RowRule("municipality_unknown", "key", q("__municipality").isNull()),
    )


def with_known_keys(fact: DataFrame, spark: SparkSession, territory: DataFrame) -> DataFrame:
    """``fact`` with the state's and the municipality's keys as their
    dimensions have them, null where they have not."""
    states = state_dim(spark).select(q("Cod_Estado").alias("__state"))
    known = territory.select(q("cod_mpio").alias("__municipality"))
    return (fact.join(states, q("estado").try_cast("int") == q("__state"), "left")
                .join(known, q("cod_mpio") == q("__municipality"), "left"))


def rule_counts(rows: DataFrame, rules: Sequence[RowRule], keys: Sequence[str]) -> DataFrame:
    """One row for each member of ``keys`` and rule: rows checked and rows that
    break it. All rules are counted in one scan and one aggregate."""
    made = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"), F.count(r.broken).alias("checked"), F.count_if(r.broken).alias("broken")) for r in rules]
    counted = rows.groupBy(*map(q, keys)).agg(F.array(*made).alias("rules"))
    return counted.select(*map(q, keys), F.inline("rules"))


def broken_rows(rows: DataFrame, rules: Sequence[RowRule], columns: Sequence[str]) -> DataFrame:
    """The rows that break a rule, with the names of those they break."""
    names = F.filter(F.array(*[F.when(r.broken, F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    return rows.select(*map(q, columns), names.alias("broken_rules")).filter(F.size("broken_rules") > 0)
