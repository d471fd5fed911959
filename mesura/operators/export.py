"""Exports: latest-year extract, one CSV file (or several of bounded size) for
each municipality (S8/S9), and the download catalogue of what was written
(S10, D31).

An export folder grows by runs. A run writes the municipalities it has into a
folder of its own, names the files there, and writes a manifest last; readers
take the files that the newest manifest lists. So a run replaces its own
municipalities and no other, and one that breaks off changes nothing."""

from __future__ import annotations

import re
import unicodedata
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mesura import schemas as S
from mesura.operators.clean import latest_year, select_priority
from mesura.operators.territory import municipality_label

EXCLUDE = set(S.DERIVED_COLUMNS) | {"Source.Name", "Fec_digitacion", "Municipio", "Subregion", "household_key"}


def q(name: str):
    return F.col(f"`{name}`")


def latest_year_extract(fact: DataFrame, names: DataFrame) -> DataFrame:
    """Latest year only, ``code - name`` label second,
    priority columns first, derived and technical columns left out."""
    df = municipality_label(latest_year(fact), names)
    return select_priority(df, S.EXTRACT_PRIORITY, exclude=EXCLUDE)


def safe_name(name: str) -> str:
    """A name as file names write it: no accents, upper case, no blanks."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
    return re.sub(r"[ /]", "_", plain.upper())


MANIFEST = "_manifest"
_ENTRIES = "cod_mpio string, file_name string, path string"


def _fs(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and its path class."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def _newest(spark: SparkSession, out_dir: str) -> int:
    """Number of the newest manifest, 0 if there is none."""
    fs, make = _fs(spark, out_dir)
    folder = make(f"{out_dir}/{MANIFEST}")
    names = [x.getPath().getName() for x in fs.listStatus(folder)] if fs.exists(folder) else []
    return max((int(n) for n in names if n.isdigit()), default=0)


def manifest(spark: SparkSession, out_dir: str) -> DataFrame:
    """The files of an export: municipality, published name, path within the
    folder. Empty before the first run is complete."""
    number = _newest(spark, out_dir)
    return spark.read.schema(_ENTRIES).parquet(f"{out_dir}/{MANIFEST}/{number}") if number else spark.createDataFrame([], _ENTRIES)


def write_run(spark: SparkSession, df: DataFrame, names: dict[str, str], out_dir: str, max_records: int = 1_000_000) -> DataFrame:
    """The municipalities of ``df`` as CSV files in a run folder of their own;
    returns their manifest entries. No reader sees them yet.

    Rows are rebalanced by municipality: AQE splits a large one over tasks and
    ``max_records`` bounds a file. The files then get the names that the
    catalogue links to, ``mpio_<code>_<NAME>_ultimo_anio.csv``, by renaming
    (a step of the file system, no data is read); further files of one
    municipality end in ``_parte<k>.csv``. A code without a name is COD<code>.
    Rows without a code are in ``sin_municipio_ultimo_anio.csv``, which no
    catalogue links to.
    """
    run = f"run-{uuid.uuid4().hex}"
    rows = spark.sql("SELECT /*+ REBALANCE(cod_mpio) */ * FROM {rows}", rows=df)
    (rows.withColumn("codigo", q("cod_mpio")).write.option("header", True).option("maxRecordsPerFile", max_records)
         .partitionBy("codigo").csv(f"{out_dir}/{run}"))
    fs, make = _fs(spark, out_dir)
    entries = []
    for folder in fs.listStatus(make(f"{out_dir}/{run}")):  # one entry a municipality
        if not folder.isDirectory():
            continue
        code = unquote(folder.getPath().getName().partition("=")[2])
        if code == "__HIVE_DEFAULT_PARTITION__":
            code, stem = None, "sin_municipio_ultimo_anio"
        else:
            plain = re.sub(r"\W", "_", code)
            stem = f"mpio_{plain}_{safe_name(names.get(code) or 'COD' + plain)}_ultimo_anio"
        parts = sorted(x.getPath().getName() for x in fs.listStatus(folder.getPath()) if x.getPath().getName().startswith("part-"))
        for k, part in enumerate(parts):
            name = f"{stem}.csv" if k == 0 else f"{stem}_parte{k + 1}.csv"
            if not fs.rename(make(folder.getPath(), part), make(f"{out_dir}/{run}/{name}")):
                raise OSError(f"{out_dir}/{run}/{name}: not renamed")
            entries.append((code, name, f"{run}/{name}"))
    return spark.createDataFrame(entries, _ENTRIES)


def publish(spark: SparkSession, entries: DataFrame, out_dir: str, after: int) -> None:
    """Manifest ``after + 1``: the entries of manifest ``after`` for the
    municipalities that ``entries`` has not, and ``entries``. It is written
    aside and gets its number by one rename, so it is there as a whole or not
    at all; another run that took the number first is an error."""
    own = entries.select(q("cod_mpio").alias("own")).distinct()
    kept = manifest(spark, out_dir).join(own, q("cod_mpio").eqNullSafe(q("own")), "left_anti")
    fs, make = _fs(spark, out_dir)
    aside, final = f"{out_dir}/{MANIFEST}/.{uuid.uuid4().hex}", f"{out_dir}/{MANIFEST}/{after + 1}"
    kept.unionByName(entries).coalesce(1).write.parquet(aside)  # a row a file
    if _newest(spark, out_dir) != after or fs.exists(make(final)) or not fs.rename(make(aside), make(final)):
        fs.delete(make(aside), True)
        raise OSError(f"{final}: written by another run")


def write_extract(spark: SparkSession, df: DataFrame, names: dict[str, str], out_dir: str, max_records: int = 1_000_000) -> None:
    """The municipalities of ``df`` replace their files in the export
    ``out_dir``; files of other municipalities stay."""
    after = _newest(spark, out_dir)
    publish(spark, write_run(spark, df, names, out_dir, max_records), out_dir, after)


def written_files(spark: SparkSession, out_dir: str) -> DataFrame:
    """Names and paths of the exported files, as the newest manifest lists them."""
    return manifest(spark, out_dir).select("file_name", "path")


def read_extract(spark: SparkSession, out_dir: str, schema: T.StructType) -> DataFrame:
    """The rows of an export, from the files of its newest manifest."""
    paths = [f"{out_dir}/{r['path']}" for r in written_files(spark, out_dir).select("path").toLocalIterator()]
    return spark.read.schema(schema).option("header", True).csv(paths) if paths else spark.createDataFrame([], schema)


def remove_unlisted(spark: SparkSession, out_dir: str) -> None:
    """Removes runs that no file of the newest manifest is in, and earlier
    manifests. For times without readers or writers."""
    fs, make = _fs(spark, out_dir)
    number = _newest(spark, out_dir)
    if number:
        listed = {r[0] for r in manifest(spark, out_dir).select(F.substring_index("path", "/", 1)).distinct().toLocalIterator()}
        old = [x.getPath() for x in fs.listStatus(make(out_dir)) if x.getPath().getName().startswith("run-") and x.getPath().getName() not in listed]
        old += [x.getPath() for x in fs.listStatus(make(f"{out_dir}/{MANIFEST}")) if x.getPath().getName() != str(number)]
        for path in old:
            fs.delete(path, True)


def parse_catalogue_names(files: DataFrame, col: str = "file_name") -> DataFrame:
    """S10 name form ``mpio_<code>_<NAME>_ultimo_anio.csv``: code and name
    (underscores to blanks); other forms are dropped."""
    name = r"^mpio_([^_]+)_(.+)_ultimo_anio\.csv$"
    return (files.where(q(col).rlike(name))
                 .select(F.regexp_extract(q(col), name, 1).alias("cod_mpio"),
                         F.regexp_replace(F.regexp_extract(q(col), name, 2), "_", " ").alias("nom_mpio"),
                         F.regexp_extract(q(col), name, 2).alias("file_part"), q(col)))


def catalogue(files: DataFrame, base_url: str = "", report_url: str = "",
              variables_url: str = "", flag_url: str = "") -> DataFrame:
    """One row for each exported municipality, sorted by code. URL
    prefixes are parameters."""
    code, part = q("cod_mpio"), q("file_part")
    return parse_catalogue_names(files).select(
        "cod_mpio", "nom_mpio",
        F.concat(F.lit(base_url), q("file_name"), F.lit("?download=1")).alias("Url_Descarga"),
        F.concat(F.lit(report_url), F.lit("informe_"), code, F.lit("_"), part, F.lit(".pdf?download=1")).alias("Url_Informe"),
        F.lit(variables_url).alias("Url_Descarga_Variables"),
        F.concat(F.lit(flag_url), code, F.lit(".png?raw=true")).alias("Bandera_escudo"),
    ).orderBy("cod_mpio")


def export_municipalities(spark: SparkSession, fact: DataFrame, names: DataFrame, out_dir: str) -> DataFrame:
    """Extract, files and catalogue in one go. ``names`` is the territory
    dimension: one row a municipality, read to the driver for the renaming."""
    known = {r[0]: r[1] for r in names.select("cod_mpio", "Municipio").collect()}
    write_extract(spark, latest_year_extract(fact, names), known, out_dir)
    return catalogue(written_files(spark, out_dir))
