"""Official projections: population by age band and households/dwellings
wide-to-long (the two projection ETLs), re-aimed at Spark.

The raw inputs (a population CSV, two projection spreadsheets) are not part
of the driver's data, so ``population_raw`` and ``projection_wide`` derive
tables of the same shape from the driver's tables; the ETL operators are the
same whatever the source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mesura import schemas as S
from mesura.functions.labels import age_band, norm_code
from mesura.operators.clean import department_filter, drop_null, filter_years, repair_headers, unpivot_years
from mesura.sources.tables import read_table

def q(name: str):
    return F.col(f"`{name}`")


def population_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population file shape, with the headers as the source writes them."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        q("c_nationkey").cast("long").alias("DPMP"),
        (F.lit(1995) + q("c_custkey") % 7).alias("AÑO"),
        F.when(q("c_custkey") % 2 == 0, "Hombres").otherwise("Mujeres").alias("GENERO"),
        F.when(q("c_custkey") % 3 == 0, S.TOWN_CENTRE).otherwise("Centro Poblado y Rural Disperso")
         .alias("ÁREA GEOGRÁFICA"),
        F.when(q("c_custkey") % 53 == 0, F.lit(None).cast("string"))
         .when(q("c_custkey") % 59 == 0, F.lit("n/a"))
         .otherwise((q("c_custkey") % 97).cast("string")).alias("EDAD_NUM"),
        (F.lit(50) + q("c_custkey") % 7).alias("POB"),
    )


def population_by_band(raw: DataFrame, years: Sequence[int]) -> DataFrame:
    """Projected population by municipality, year, area,
    sex and age band. Rows with a null key are dropped, sums of nothing are 0."""
    df = filter_years(repair_headers(raw, S.POPULATION_HEADERS), years, "AÑO")
    age = q("Edad_Num").cast("string").try_cast("double")
    band = (F.when(q("Edad_Num").isNull(), F.lit(S.UNKNOWN))
             .when(age.isNull(), F.lit(S.UNKNOWN))
             .otherwise(age_band(age)))
    out = df.select(
        norm_code(q("DPMP")).alias("cod_mpio"),
        q("AÑO").cast("long").alias("anio"),
        F.when(q("AREA_TXT") == S.TOWN_CENTRE, 1).otherwise(3).cast("long").alias("Cod_clase"),
        F.coalesce(F.when(q("Genero") == "Hombres", 1).when(q("Genero") == "Mujeres", 2), F.lit(0))
         .cast("long").alias("sexo_persona"),
        band.alias("Rango_Edad"),
        q("Pob").alias("Pob"))
    keys = ["cod_mpio", "anio", "Cod_clase", "sexo_persona", "Rango_Edad"]
    return (drop_null(out, keys).groupBy(*keys)
            .agg(F.coalesce(F.sum("Pob"), F.lit(0)).cast("long").alias("Poblacion_Proyectada")))


def projection_wide(spark: SparkSession, sf_dir: str, kind: str, years: Sequence[int]) -> DataFrame:
    """Sheet shape: cod_dpto, nom_dpto, cod_mpio, nom_mpio, Area and one
    column per year. Households count orders, dwellings count distinct
    customers, per nation, area and year of ``years``; a Total row per nation."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation")
    j = (o.join(c, q("o_custkey") == q("c_custkey"))
          .join(n, q("c_nationkey") == q("n_nationkey"))
          .withColumn("yr", F.year("o_orderdate").cast("string"))
          .withColumn("Area", F.when(q("o_orderkey") % 2 == 0, S.TOWN_LABEL).otherwise(S.RURAL_LABEL)))
    measure = F.count(F.lit(1)) if kind == "households" else F.count_distinct(q("o_custkey"))
    ids = [(F.lit(5) + (q("n_regionkey") % 2) * 3).cast("string").alias("cod_dpto"),
           F.concat(F.lit("DPTO_"), q("n_regionkey").cast("string")).alias("nom_dpto"),
           F.concat(q("c_nationkey").cast("string"), F.lit(".0")).alias("cod_mpio"),
           q("n_name").alias("nom_mpio")]
    years = [str(y) for y in years]
    parts = j.groupBy(*ids, "Area").pivot("yr", years).agg(measure)
    total = j.groupBy(*ids).pivot("yr", years).agg(measure).withColumn("Area", F.lit(S.TOTAL_LABEL))
    out = parts.unionByName(total)
    return out.select("cod_dpto", "nom_dpto", "cod_mpio", "nom_mpio", "Area",
                      *[q(y).cast("double").alias(y) for y in years])


def area_code(area) -> object:
    """Cabecera 1; rural or centro 2; total 0; else -1 (first match)."""
    a = F.lower(F.trim(area.cast("string")))
    return (F.when(a.contains("cabecera"), 1).when(a.contains("rural") | a.contains("centro"), 2)
             .when(a.contains("total"), 0).otherwise(-1)).cast("long")


def wide_to_long(wide: DataFrame, value: str, department: str, years: Sequence[int]) -> DataFrame:
    """The projection ETL. All year columns that
    the sheet has are read; ``years`` are kept."""
    df = drop_null(department_filter(wide, department), ["cod_mpio"])
    df = df.withColumns({"cod_mpio": norm_code(q("cod_mpio")), "Cod_clase": area_code(q("Area"))})
    long = unpivot_years(df, ["cod_mpio", "Cod_clase"], value)
    return filter_years(long, years).select("cod_mpio", "anio", "Cod_clase", value)
