"""Row groups of Parquet tables (S3), from the footers alone.

The driver lists files; tasks read the footers, one file at a time, so a table
of many files is described without a scan and without the driver opening any.
A footer holds no rows, which is why this is the one place of the survey side
where tasks run Python.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mesura.sources.files import list_files

ROW_GROUP = ("table_name string, file string, row_group int, row_count long, total_bytes long, "
             "columns array<struct<column_name:string,physical_type:string,repeated:boolean,null_count:long,compressed_bytes:long,"
             "low:string,high:string,low_number:double,high_number:double>>")


def row_groups(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """One row for each row group of each file of ``tables`` (name -> path):
    its rows, its bytes before compression, and for each leaf column the nulls,
    the bytes on disk and the bounds, as text and (numbers) as doubles.

    ``repeated`` marks leaves inside lists, whose counts are of entries. Bounds
    and nulls are null where the writer left them out; a footer's text bounds
    may be shortened by its writer. A table without files gives no row, a file
    without row groups neither."""
    files = [(name, file) for name, path in tables.items() for file in list_files(spark, path)]
    if not files:
        return spark.createDataFrame([], ROW_GROUP)
    parts = min(len(files), 4 * spark.sparkContext.defaultParallelism)
    listed = spark.createDataFrame(files, "table_name string, file string").repartition(parts, "file")

    def footers(batches):  # nested: sent by value, so executors need no copy of this package
        import re

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow.fs import FileSystem

        leaf = pa.struct([("column_name", pa.string()), ("physical_type", pa.string()), ("repeated", pa.bool_()), ("null_count", pa.int64()),
                          ("compressed_bytes", pa.int64()), ("low", pa.string()), ("high", pa.string()), ("low_number", pa.float64()), ("high_number", pa.float64())])
        schema = pa.schema([("table_name", pa.string()), ("file", pa.string()), ("row_group", pa.int32()), ("row_count", pa.int64()),
                            ("total_bytes", pa.int64()), ("columns", pa.list_(leaf))])

        def text(x):
            return x.decode("utf-8", "replace") if isinstance(x, bytes) else str(x)

        for batch in batches:
            for name, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                uri = re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "/", file))
                fs, path = FileSystem.from_uri(uri)
                with fs.open_input_file(path) as source:
                    meta = pq.read_metadata(source)
                repeated = [meta.schema.column(k).max_repetition_level > 0 for k in range(meta.num_columns)]
                for g in range(meta.num_row_groups):
                    group, leaves = meta.row_group(g), []
                    for k in range(group.num_columns):
                        c = group.column(k)
                        s = c.statistics if c.is_stats_set else None
                        bounds = (s.min, s.max) if s is not None and s.has_min_max else (None, None)
                        number = all(isinstance(b, (int, float)) and not isinstance(b, bool) for b in bounds)
                        leaves.append({"column_name": c.path_in_schema, "physical_type": c.physical_type, "repeated": repeated[k],
                                       "null_count": s.null_count if s is not None and s.has_null_count else None, "compressed_bytes": c.total_compressed_size,
                                       "low": None if bounds[0] is None else text(bounds[0]), "high": None if bounds[1] is None else text(bounds[1]),
                                       "low_number": float(bounds[0]) if number else None, "high_number": float(bounds[1]) if number else None})
                    yield pa.RecordBatch.from_pylist([{"table_name": name, "file": file, "row_group": g, "row_count": group.num_rows,
                                                       "total_bytes": group.total_byte_size, "columns": leaves}], schema=schema)

    return listed.mapInArrow(footers, ROW_GROUP)


def number_facts(groups: DataFrame) -> DataFrame:
    """Rows, nulls and bounds of each plain number column of the tables behind
    ``groups`` (of ``row_groups``), merged over all row groups. A bound or the
    nulls are null if any row group that has a value leaves them out."""
    leaves = groups.select("table_name", "row_count", F.explode("columns").alias("c")).select("table_name", "row_count", "c.*")
    plain = leaves.filter("not repeated and physical_type in ('INT32', 'INT64', 'FLOAT', 'DOUBLE')")
    known = F.bool_and(q_known())
    return (plain.groupBy("table_name", "column_name")
            .agg(F.sum("row_count").alias("row_count"), F.when(F.bool_and(F.col("null_count").isNotNull()), F.sum("null_count")).alias("null_count"),
                 F.when(known, F.min("low_number")).alias("low"), F.when(known, F.max("high_number")).alias("high"),
                 # dates and instants are integers on disk, their bounds are none
                 F.bool_or(F.col("low").isNotNull() & F.col("low_number").isNull()).alias("__other"))
            .filter("not __other").drop("__other"))


def q_known():
    """The row group states bounds, or has no value to bound."""
    return F.col("low_number").isNotNull() | (F.col("null_count") == F.col("row_count"))
