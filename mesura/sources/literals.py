"""Literal dimension and parameter tables (S11) as small DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from mesura import schemas as S


def _df(spark: SparkSession, rows, *fields) -> DataFrame:
    return spark.createDataFrame(rows, S.literal_schema(*fields))


def state_dim(spark):
    return _df(spark, S.STATE_ROWS, ("Cod_Estado", T.IntegerType()), ("Descripcion_Motivo", T.StringType()),
               ("Categoria_Macro", T.StringType()))


def mark_dim(spark):
    return _df(spark, S.MARK_ROWS, ("Cod_Marca", T.IntegerType()), ("Detalle", T.StringType()))


def age_band_dim(spark):
    return _df(spark, [(t, i) for i, (_, t) in enumerate(S.AGE_BANDS, start=1)],
               ("Rango_Edad", T.StringType()), ("Orden", T.IntegerType()))


def indicator_dim(spark):
    return _df(spark, S.INDICATOR_ROWS, ("Dimension_IPM", T.StringType()), ("Categoria", T.StringType()))


def household_indicator_dim(spark):
    rows = [(i, c, "Gasto" if "Gasto" in i else "Condiciones") for i, c in S.HOUSEHOLD_INDICATOR_ROWS]
    return _df(spark, rows, ("Indicador", T.StringType()), ("Categoria", T.StringType()), ("Tipo", T.StringType()))


def housing_category_dim(spark):
    return _df(spark, S.HOUSING_CATEGORY_ROWS, ("Categoria", T.StringType()), ("Tipo", T.StringType()))


def housing_indicator_dim(spark):
    return _df(spark, S.HOUSING_INDICATOR_ROWS, ("Ausencia_Servicio", T.StringType()),
               ("Dimension", T.StringType()))


def one_column(spark, rows, name):
    return _df(spark, [(r,) for r in rows], (name, T.StringType()))


def parameter_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """All literal dimension and parameter tables of the model by name."""
    return {
        "state": state_dim(spark), "mark": mark_dim(spark), "age_band": age_band_dim(spark), "indicator": indicator_dim(spark),
        "household_indicator": household_indicator_dim(spark), "housing_category": housing_category_dim(spark),
        "housing_indicator": housing_indicator_dim(spark), "housing_type": one_column(spark, S.HOUSING_TYPE_ROWS, "Tipo"),
        "event": one_column(spark, S.EVENT_ROWS, "Evento"), "deprivation": one_column(spark, S.DEPRIVATION_ROWS, "Privacion"),
        "sanitary_block": one_column(spark, S.SANITARY_BLOCK_ROWS, "Bloque"), "level": one_column(spark, S.LEVEL_ROWS, "Nivel"),
    }
