"""Exact top-k inner products by a three-phase uniform threshold.

A vector's components are dealt to ``parts`` groups; each group is a node
that knows one partial product for every pair of query and candidate, and the
score is the sum over the nodes.

1. Each node sends, for each query, its few largest partial products (the
   local score lists). The candidates on them are scored exactly; the k-th
   best of these scores is a lower bound of the true k-th best.
2. A candidate that reaches the bound has on some node at least the bound
   divided by the number of nodes, whatever the signs. That uniform cutoff
   goes to all nodes, and each sends its entries that reach it.
3. What was sent on all nodes is summed; what is missing on a node is below
   the cutoff there, which rules most candidates out. The rest is resolved
   exactly, and the best k are ranked.

Scale. Equal vectors are one class with its k + 1 least ids, so a vector that
a third of all rows share is one candidate and one query. Query classes come
in blocks and candidates in cells of bounded size; a block meets a cell in one
task, by an equi-join of (block, cell, node). Neither side is collected or
broadcast.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mesura.llm.common import read_table, register, shared_table


@dataclass(frozen=True)
class Params:
    """``k`` results a query; ``parts`` nodes; ``local`` entries of a local
    list. ``block`` queries and ``cell`` candidates meet in one task."""

    k: int = 5
    parts: int = 2
    local: int = 64
    block: int = 2048
    cell: int = 16384
    scale: int = 256


def quantised(vectors: DataFrame, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """Rows (vec_id, v): floor(scale * x) of each component x as double, for
    vectors without null or non-finite components."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(fine)
            .select("vec_id", F.transform("v", lambda x: F.floor(x * F.lit(scale)).cast("long")).alias("v")))


def _matrix(column: pa.ChunkedArray, part: int, parts: int) -> np.ndarray:
    """Components of one node as a float64 matrix; products and sums of them
    are exact below 2**53. Larger ones are computed as Python integers."""
    rows = column.to_pylist()
    width = max((len(r) for r in rows), default=0)
    lo, hi = width * part // parts, width * (part + 1) // parts
    big = max((abs(x) for r in rows for x in (min(r, default=0), max(r, default=0))), default=0)
    if big * big * max(1, width) < 1 << 53:
        return np.array([r[lo:hi] for r in rows], float).reshape(len(rows), hi - lo)
    return np.array([[int(x) for x in r[lo:hi]] for r in rows], object).reshape(len(rows), hi - lo)


def _product(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    if q.dtype == object or c.dtype == object:
        return q.astype(object) @ c.astype(object).T
    return q @ c.T


_ENTRY = pa.schema([("qc", pa.int64()), ("cc", pa.int64()), ("node", pa.int32()), ("s", pa.int64())])


def _entries(keep, parts: int):
    """For a cell of candidates and a block of queries on one node, the
    entries that ``keep(products, query table)`` marks."""
    def run(key: tuple[pa.Scalar, ...], cells: pa.Table, queries: pa.Table) -> pa.Table:
        node, out = key[2].as_py(), []
        if cells.num_rows and queries.num_rows:
            c = _matrix(cells["v"], node, parts)
            cc = cells["cc"].to_numpy()
            qc = queries["qc"].to_numpy()
            step = max(1, (1 << 22) // len(c))
            for at in range(0, len(qc), step):
                part = queries.slice(at, step)
                s = _product(_matrix(part["v"], node, parts), c)
                i, j = keep(s, part)
                out.append(pa.table([pa.array(qc[at:at + step][i]), pa.array(cc[j]), pa.array(np.full(len(i), node, np.int32)), pa.array(s[i, j].astype(np.int64))], schema=_ENTRY))
        return pa.concat_tables(out) if out else _ENTRY.empty_table()
    return run


def _largest(local: int):
    def keep(s: np.ndarray, _: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        n = min(local, s.shape[1])
        j = np.argpartition(-s, n - 1, axis=1)[:, :n] if s.shape[1] > n else np.tile(np.arange(n), (len(s), 1))
        return np.repeat(np.arange(len(s)), n), j.ravel()
    return keep


def _reaching(parts: int):
    def keep(s: np.ndarray, queries: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return np.nonzero(parts * s >= queries["bound"].to_numpy()[:, None])
    return keep


def _exact(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (qc, cc) with their whole inner product ``score``."""
    dot = F.aggregate(F.zip_with("qv", "cv", lambda x, y: x * y), F.lit(0).cast("long"), lambda a, x: a + x)
    return (pairs.join(classes.select(F.col("class").alias("qc"), F.col("v").alias("qv")), "qc")
            .join(classes.select(F.col("class").alias("cc"), F.col("v").alias("cv")), "cc").select("qc", "cc", dot.alias("score")))


def top_k(vectors: DataFrame, is_query, p: Params = Params(), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each row of ``vectors`` that
    the condition ``is_query`` (a function of the id column) marks, the ``k``
    other rows with the largest inner product, ties to the least id.

    Null ids, null vectors and vectors with a null or non-finite component
    take no part; vectors of different lengths meet only their like. Rows that
    repeat an id are one row if the vectors are equal; else each counts. Other
    columns are not read. An empty table gives an empty result. Scores are
    longs: components so large that a score could leave 2**60 are an error.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, p.scale, id_col, vec_col)
    ordered = Window.partitionBy("v").orderBy("vec_id")
    # the rank limit runs in each task before the shuffle: a common vector sends k + 1 rows from each
    firsts = rows.distinct().withColumn("nth", F.row_number().over(ordered)).filter(F.col("nth") <= p.k + 1)
    classes = firsts.groupBy("v").agg(F.min("vec_id").alias("class"), F.sort_array(F.collect_list("vec_id")).alias("ids"))  # k + 1 ids at most
    classes = shared_table(spark, classes, "classes")
    facts = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))).alias("big"), F.max(F.size("v")).alias("width")).first()
    if (facts["big"] or 0.0) ** 2 * max(1, facts["width"] or 0) * p.parts >= 2.0 ** 60:
        raise ValueError(f"components up to {facts['big']:.3g} / {p.scale} in {facts['width']} dimensions: their scores are no longs")
    # a repeated id can lead two classes; number them (the numbers are written, so they stay)
    twice = classes.groupBy("class").count().filter("count > 1")
    if not twice.isEmpty():
        classes = shared_table(spark, classes.withColumn("class", F.monotonically_increasing_id()), "numbered")
    asked = rows.filter(is_query(F.col("vec_id"))).join(classes.select("v", "class"), "v").select(F.col("vec_id").alias("query_id"), F.col("class").alias("qc")).distinct()
    # written apart: both sides of a cogroup must not share columns
    queries = shared_table(spark, classes.join(asked.select(F.col("qc").alias("class")).distinct(), "class", "left_semi").select(F.col("class").alias("qc"), "v", F.size("v").alias("d")), "queries")
    n, m = facts["n"], queries.count()
    cells, blocks = max(1, math.ceil(n / p.cell)), max(1, math.ceil(m / p.block))
    # vectors of another length never meet: the length is part of the key
    left = (classes.select(F.col("class").alias("cc"), "v", F.size("v").alias("d"), F.pmod(F.xxhash64("v", F.lit(1)), F.lit(cells)).alias("cell"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("node", F.explode(F.sequence(F.lit(0), F.lit(p.parts - 1)))))
    right = (queries.withColumn("block", F.pmod(F.xxhash64("v", F.lit(2)), F.lit(blocks)).cast("int"))
             .withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long")))).withColumn("node", F.explode(F.sequence(F.lit(0), F.lit(p.parts - 1)))))
    keys = ["block", "cell", "node", "d"]

    def nodes(right: DataFrame, keep) -> DataFrame:
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_entries(keep, p.parts), "qc long, cc long, node int, s long")

    # 1: local lists, and the (k + 1)-th best of their exact scores
    listed = _exact(nodes(right, _largest(p.local)).select("qc", "cc").distinct(), classes)
    best = Window.partitionBy("qc").orderBy(F.desc("score"), "cc")
    bound = (listed.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= p.k + 1)
             .groupBy("qc").agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n")))
    # fewer classes than k + 1: all of them are wanted
    bound = shared_table(spark, bound.select("qc", F.when(F.col("n") > p.k, F.col("low")).otherwise(F.lit(-((1 << 61) // p.parts))).alias("bound")), "bounds")
    # 2 and 3
    sent = nodes(right.join(bound, "qc"), _reaching(p.parts))
    known = sent.groupBy("qc", "cc").agg(F.sum("s").alias("s"), F.count(F.lit(1)).alias("n")).join(bound, "qc")
    left_out = F.lit(p.parts) - F.col("n")
    able = known.filter((F.col("n") == p.parts) & (F.col("s") >= F.col("bound")) | (F.col("n") < p.parts) & (p.parts * F.col("s") + left_out * F.col("bound") >= p.parts * F.col("bound")))
    able = able.select("qc", "cc", "s", "n")
    whole = able.filter(F.col("n") == p.parts).select("qc", "cc", F.col("s").alias("score"))
    scores = whole.union(_exact(able.filter(F.col("n") < p.parts).select("qc", "cc"), classes))
    heads = classes.select(F.col("class").alias("cc"), "ids")
    order = Window.partitionBy("qc").orderBy(F.desc("score"), "first")
    top = (scores.join(classes.select(F.col("class").alias("cc"), F.col("ids")[0].alias("first")), "cc").withColumn("r", F.row_number().over(order)).filter(F.col("r") <= p.k + 1)
           .select("qc", "cc", "score").join(heads, "cc").select("qc", "score", F.explode("ids").alias("vec_id")))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (asked.join(top, "qc").filter("vec_id != query_id").withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= p.k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@register("op5_exact_top_k", OP5_SQL)
def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)
