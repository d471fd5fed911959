"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this package wants. AQE re-plans joins with runtime
# sizes (sort-merge -> broadcast when a side turns out small), coalesces small
# shuffle partitions and splits skewed ones; that is what keeps a hot
# municipality or year from landing in one task.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.parquet.compression.codec": "snappy",
}


def get_session(master: str = "local[8]", app: str = "mesura",
                shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared file system (HDFS, object store);
    it is read from the session and never replaced, and a missing setting is
    an error: executors cannot see a folder of the driver's machine. A session
    with a ``local`` master alone gets a private folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext._conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir is unset; name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="mesura-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop file system of ``path`` (works for
    local folders, HDFS and object stores alike)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def input_signature(spark: SparkSession, path: str) -> str:
    """Files of ``path`` with lengths and modification times, as its Hadoop
    file system lists them: changes whenever the input is replaced."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return f"{path}:absent"
    found, files = [], fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath().toString()}:{f.getLen()}:{f.getModificationTime()}")
    return "\n".join(sorted(found))


def join_path(base: str, *parts: str) -> str:
    out = base.rstrip("/")
    for p in parts:
        out = out + "/" + p.strip("/")
    return out if "://" in out or out.startswith("/") else os.path.abspath(out)
