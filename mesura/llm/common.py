"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mesura.session import ensure_checkpoint_dir, join_path

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's source files to the executors, once a context, so
    that tasks can import it wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[2]
        file = Path(tempfile.mkdtemp(prefix="mesura-src-")) / "mesura_src.zip"
        with zipfile.ZipFile(file, "w") as z:
            for f in sorted((root / "mesura").rglob("*.py")):
                z.write(f, f.relative_to(root))
        sc.addPyFile(str(file))
        _SHIPPED.add(sc.applicationId)


def register(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    The written files cut the lineage: a lost executor makes a later stage
    read them again instead of running the expensive map a second time.
    """
    path = join_path(ensure_checkpoint_dir(spark), "mesura_llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tokenizer_file(name: str, folder: str | None = None) -> str:
    """Path of a public vocabulary file; ``folder`` overrides the installed one."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def doc_split(id_col: str, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod`` (null id: null)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % mod


def texts_of(column: pa.ChunkedArray | pa.Array) -> Iterator[str]:
    """Python strings of an Arrow text column, null as the empty text, one
    value at a time (a batch of long texts is never copied as a whole)."""
    for v in column:
        yield v.as_py() or ""


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 over uint64 values (wraps around)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
