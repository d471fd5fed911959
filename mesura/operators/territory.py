"""Territory dimension, lookup joins and the name-normalised join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mesura import schemas as S
from mesura.functions.text import normalise_name
from mesura.operators.clean import first_per_key
from mesura.sources.tables import read_table


def q(name: str):
    return F.col(f"`{name}`")


def territory_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per 5-digit code (first by name), typed and renamed:
    cod_mpio, Municipio, Subregion, Cod_SubRegion."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    t = n.join(r, q("n_regionkey") == q("r_regionkey"), "left").select(
        F.lpad(q("n_nationkey").cast("string"), 5, "0").alias("cod_mpio"),
        q("n_name").alias("Municipio"), q("r_name").alias("Subregion"),
        F.lpad(q("n_regionkey").cast("string"), 2, "0").alias("Cod_SubRegion"))
    return first_per_key(t, "cod_mpio", ["Municipio"])


def municipality_label(df: DataFrame, names: DataFrame, code: str = "cod_mpio",
                       name_col: str = "Municipio") -> DataFrame:
    """``code - name`` from a lookup join, ``code - Sin nombre`` when
    the code has no name (not a CASE with one arm per code)."""
    lk = names.select(q(code).alias("__code"), q(name_col).alias("__name"))
    j = df.join(lk, q(code) == q("__code"), "left")
    label = F.concat(q(code), F.lit(" - "), F.coalesce(q("__name"), F.lit("Sin nombre")))
    return j.withColumn("NOM_MUNICIPIO", label).drop("__code", "__name")


def alias_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(S.NAME_ALIASES, "dim_norm string, file_norm string")


def normalised_name_join(dim: DataFrame, files: DataFrame, spark: SparkSession,
                         dim_name: str = "nom_mpio", file_name: str = "file_name") -> DataFrame:
    """Dimension names and resource names compared without accents, case
    and blanks; seven names go through the alias table first. Of several files
    with one key the least name is taken; a dimension row without a match
    gets ""."""
    al = alias_table(spark).select(normalise_name(q("dim_norm")).alias("__ak"), normalise_name(q("file_norm")).alias("__af"))
    d = dim.withColumn("__k", normalise_name(q(dim_name)))
    d = d.join(al, q("__k") == q("__ak"), "left") \
         .withColumn("__k", F.coalesce(q("__af"), q("__k"))).drop("__ak", "__af")
    f = files.groupBy(normalise_name(q(file_name)).alias("__fk")).agg(F.min(q(file_name)).alias("matched_file"))
    return d.join(f, q("__k") == q("__fk"), "left") \
            .withColumn("matched_file", F.coalesce(q("matched_file"), F.lit(""))).drop("__k", "__fk")
