"""Ranks, accumulation and running sums over orders of any size.

A window without keys, or with a key that holds most rows, puts its rows in
one task. Here the rows are dealt by ranges of (keys, order), so a large group
is many ranges; each range is summed for itself, and what the ranges before it
hold of the same key is added. Only the first key of a range can have rows in
earlier ranges, so no more than one carried sum a range is joined back.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mesura.functions.blank import div
from mesura.plans.evaluate import join_on_keys, q
from mesura.session import ensure_checkpoint_dir, join_path


class Scratch:
    """Tables written on the way to a result, in the shared checkpoint folder.
    A table cuts the lineage: a lost executor makes later steps read it again.
    ``drop`` removes one that no later step reads."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self.paths: dict[int, str] = {}
        self.kept: list[DataFrame] = []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = join_path(ensure_checkpoint_dir(self.spark), "mesura_scratch", f"{self.name}-{name}-{uuid.uuid4().hex}")
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        self.kept.append(out)  # so that no other frame gets its id
        return out

    def drop(self, df: DataFrame) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(df)))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], sums: Mapping[str, Column], scratch: Scratch) -> DataFrame:
    """``df`` with a column for each of ``sums``: its sum over the rows of the
    same ``keys`` up to this one in ``order`` (names, or ``F.desc`` of names).
    Rows of one place in the order have their sums in any order."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *map(q, keys), *order).withColumn("__part", F.spark_partition_id())
    dealt = scratch.write(ranged, "ranges")  # the number of a row's range must not change between two readings
    own = Window.partitionBy("__part", *map(q, keys)).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = dealt.withColumns({name: F.sum(x).over(own) for name, x in sums.items()})
    totals = dealt.groupBy("__part", *map(q, keys)).agg(*[F.sum(x).alias(f"__{name}") for name, x in sums.items()])
    before = Window.partitionBy(*(map(q, keys) if keys else [F.lit(0)])).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (totals.withColumns({"__ranges": F.count(F.lit(1)).over(before), **{f"__{name}": F.sum(f"__{name}").over(before) for name in sums}})
               .filter("__ranges > 0").drop("__ranges"))  # without keys: a row a range
    joined = join_on_keys(rows, carried, ["__part", *keys])
    added = {name: F.when(q(f"__{name}").isNull(), q(name)).otherwise(q(name) + q(f"__{name}")) for name in sums}
    return joined.withColumns(added).drop("__part", *[f"__{name}" for name in sums])


def dense_ranks(df: DataFrame, keys: Sequence[str], value: str, name: str, scratch: Scratch, descending: bool = True, blank_as_zero: bool = True) -> DataFrame:
    """``df`` with the dense rank of ``value`` among the rows of the same
    ``keys``. Ties share a rank and BLANK ranks as 0 (else last). The distinct
    values are ranked, so a value that many rows share is one row."""
    of = F.coalesce(q(value), F.lit(0)) if blank_as_zero else q(value)
    rows = df.withColumn("__value", of)
    order = F.desc_nulls_last("__value") if descending else F.asc_nulls_last("__value")
    places = running(rows.select(*map(q, keys), "__value").distinct(), keys, [order], {name: F.lit(1)}, scratch)
    return join_on_keys(rows, places.withColumn(name, q(name).cast("long")), [*keys, "__value"]).drop("__value")


def accumulated(df: DataFrame, keys: Sequence[str], value: str, name: str, scratch: Scratch) -> DataFrame:
    """``df`` with the sum of the values that are not below the row's (peers
    whole, BLANK where the value is) and, in ``<name>_pct``, its share of the
    sum of all. Values that are equal are added up before they are ordered."""
    equal = df.filter(q(value).isNotNull()).groupBy(*map(q, keys), q(value)).agg(F.sum(q(value)).alias("__equal"))
    along = running(equal, keys, [F.desc(value)], {name: F.col("__equal")}, scratch).select(*map(q, keys), q(value), q(name))
    whole = df.groupBy(*map(q, keys)).agg(F.sum(q(value)).alias("__whole"))
    out = join_on_keys(join_on_keys(df, along, [*keys, value]), whole, keys)
    return out.withColumn(f"{name}_pct", div(q(name), q("__whole"))).drop("__whole")
