"""The survey ETL end to end: a folder of CSV files to the enriched,
year-partitioned Parquet table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mesura.operators.clean import coerce_types, repair_headers
from mesura.operators.derive import enrich
from mesura.sources.files import read_csv_folder, write_parquet

REJECTED = "__rejected"


def load_survey(spark: SparkSession, folder: str, columns: Sequence[str] | None = None, encoding: str = "UTF-8") -> DataFrame:
    """All files of the folder, headers repaired, values typed
    by name. Column ``__rejected`` counts a row's values that are no integer.
    ``columns`` that the files lack are added as null."""
    df = coerce_types(repair_headers(read_csv_folder(spark, folder, encoding=encoding)), rejected=REJECTED)
    missing = {c: F.lit(None).cast("string") for c in columns or () if c not in df.columns}
    return coerce_types(df.withColumns(missing), text_columns=()) if missing else df


def run_survey_etl(spark: SparkSession, folder: str, out: str, columns: Sequence[str] | None = None, encoding: str = "UTF-8") -> DataFrame:
    """Reads, repairs, types, enriches and writes; returns one row for each
    source file: rows and rejected values. Rows meet by year in files of
    bounded size; the counts come from the written table."""
    typed = load_survey(spark, folder, columns, encoding)
    rows = spark.sql("SELECT /*+ REBALANCE(anio) */ * FROM {rows}", rows=typed)
    write_parquet(enrich(rows).sortWithinPartitions("anio", "cod_mpio"), out, ["anio"])
    written = spark.read.parquet(out)
    return written.groupBy("`Source.Name`").agg(F.count(F.lit(1)).alias("rows"), F.sum(REJECTED).cast("long").alias("rejected"))
