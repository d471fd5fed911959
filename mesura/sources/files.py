"""File sources and sinks: the survey CSV folder (S4), the population CSV (S5),
footer facts of a Parquet table (S3) and the Parquet sink (S7)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Data files under ``folder`` (a folder, file or glob), as its file system
    lists them; names with a leading ``_`` or ``.`` are no data."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in fs.globStatus(root) or []:
        listed = fs.listFiles(status.getPath(), True)
        while listed.hasNext():
            path = listed.next().getPath()
            if not path.getName().startswith(("_", ".")):
                found.append(path.toString())
    return sorted(found)


def _first_line(spark: SparkSession, file: str, encoding: str) -> str | None:
    """The first line of a file, unpacked by its suffix; None if it is empty."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = path.getFileSystem(conf).open(path)
    try:
        text = jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, encoding)
        return jvm.java.io.BufferedReader(text).readLine()
    finally:
        stream.close()


def csv_headers(spark: SparkSession, folder: str, sep: str = ";", encoding: str = "UTF-8") -> dict[tuple[str, ...], list[str]]:
    """Column names -> files that have them in this order. A byte-order mark is
    dropped; a column without a name is ``_c<place>`` and a name that repeats
    gets its place behind it. Files without a line are left out. One line of
    each file is read, on the driver; files are listed, not scanned."""
    found: dict[tuple[str, ...], list[str]] = {}
    for file in list_files(spark, folder):
        line = _first_line(spark, file, encoding)
        if line is not None:
            names: list[str] = []
            for k, name in enumerate(line.removeprefix("\ufeff").split(sep)):
                name = name.strip() or f"_c{k}"
                names.append(f"{name}{k}" if name.lower() in [n.lower() for n in names] else name)
            found.setdefault(tuple(names), []).append(file)
    return found


def read_csv_folder(spark: SparkSession, folder: str, sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """Every CSV file of a folder, ``;``-separated, no quoting, the header
    of each file promoted by itself; the file name is kept as ``Source.Name``.

    Files of one header are read together under its names, and the groups are
    united by name (whatever the case): a column that a file lacks is null
    there. All columns are read as text and typed afterwards by name
    (operators.clean.coerce_types)."""
    parts = []
    for names, files in csv_headers(spark, folder, sep, encoding).items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        df = spark.read.schema(schema).option("header", True).option("sep", sep).option("quote", "").option("encoding", encoding).csv(files)
        parts.append(df.withColumn("Source.Name", F.col("_metadata.file_name")))
    if not parts:
        raise ValueError(f"{folder}: no CSV file with a header")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_population_csv(spark: SparkSession, path: str, encodings: tuple[str, ...] = ("UTF-8", "ISO-8859-1")) -> DataFrame:
    """The population projection file, in the first encoding under which
    its header holds no replacement character."""
    for encoding in encodings:
        df = spark.read.option("header", True).option("encoding", encoding).csv(path)
        if not any("\ufffd" in c for c in df.columns):
            return df
    raise ValueError(f"{path}: no encoding of {encodings} reads its header")


def parquet_facts(spark: SparkSession, path: str) -> DataFrame:
    """S3: one row (column_name, data_type, position, row_count) for each
    column of a Parquet table. The count needs no column, so the scan reads
    footers and no pages."""
    df = spark.read.parquet(path)
    columns = spark.createDataFrame([(f.name, f.dataType.simpleString(), k) for k, f in enumerate(df.schema.fields)],
                                    "column_name string, data_type string, position int")
    return columns.withColumn("row_count", F.lit(df.count()).cast("long"))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, max_records: int = 5_000_000) -> None:
    """Snappy Parquet, overwrite, files of bounded size; the commit
    protocol replaces the table atomically per job."""
    w = df.write.mode("overwrite").option("compression", "snappy").option("maxRecordsPerFile", max_records)
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
