"""Embedding whitening from a bit-sliced scatter matrix.

Each entry c of a vector becomes the integer x = floor(1024 * c) + 100000. Per
dimension, x less the dimension's least x is cut into bit planes, and a plane
of 64 rows is one machine word. The sum of x_i * x_j over all rows is the sum
over pairs of planes a of i and b of j of 2**(a + b) times the number of rows
whose bits are set in both: AND, popcount, weight. All of it is integer
arithmetic, so the sums and the scatter matrix are exact; they are centred as
integers (n * sum x_i x_j - S_i * S_j) before the one division that makes the
covariance double, and ``eigh`` gives its components.

Scale. A task keeps one block of rows and one matrix of the dimensions' pairs,
and sends its matrix once; matrices are added in a shuffle by pair. The driver
gets a number for each pair of dimensions, whatever the number of rows. Rows
are read three times (lengths, extremes, scatter), then whitened; nothing of a
row is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mesura.llm.common import read_table, register, shared_table

SCALE, SHIFT = 1024.0, 100_000
LIMIT = 2.0 ** 52  # an entry of this size or more has no long x
BLOCK = 4096  # rows packed at once, a multiple of 64
_LOW = 60  # sums travel in two parts, so that each part has room to be added


def usable(vector: Column) -> Column:
    """Not null, and all entries finite numbers that x has room for."""
    return F.coalesce(F.forall(vector, lambda c: F.coalesce(F.abs(c) < LIMIT, F.lit(False))), F.lit(False))


def integers(vectors: pa.Array, size: int) -> np.ndarray:
    """x of each entry, rows by dimensions."""
    c = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    return np.floor(SCALE * c).astype(np.int64) + SHIFT


@dataclass(frozen=True)
class Planes:
    """Which bits there are: dimension and place of each plane, in order of
    dimensions. ``least`` is taken from each dimension's x."""

    least: np.ndarray
    dim: np.ndarray
    bit: np.ndarray

    @classmethod
    def of(cls, least: np.ndarray, most: np.ndarray) -> "Planes":
        bits = [(int(b) - int(a)).bit_length() for a, b in zip(least, most)]
        return cls(least, np.repeat(np.arange(len(bits)), bits), np.concatenate([np.arange(b) for b in bits] or [[]]).astype(np.int64))

    def pack(self, x: np.ndarray) -> np.ndarray:
        """Planes by words: bit r of a plane's words is its bit of row r."""
        rows = -len(x) % 64
        u = (x - self.least).astype(np.uint64)
        u = np.concatenate([u, np.zeros((rows, u.shape[1]), np.uint64)])
        out = np.empty((len(self.dim), len(u) // 64), np.uint64)
        for b in np.unique(self.bit):
            at = np.flatnonzero(self.bit == b)
            set_ = ((u[:, self.dim[at]] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
            out[at] = np.ascontiguousarray(np.packbits(set_.T, axis=1)).view(np.uint64)
        return out


def scatter(words: np.ndarray, planes: Planes, size: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the shifted x and of their products, from planes by words: the
    upper triangle, entries of type ``kind``."""
    one = np.array([1 << int(b) for b in planes.bit], dtype=kind)
    sums, products = np.zeros(size, kind), np.zeros((size, size), kind)
    if not len(planes.dim):
        return sums, products
    start = np.flatnonzero(np.concatenate([[True], planes.dim[1:] != planes.dim[:-1]]))
    own = planes.dim[start]
    sums[own] = np.add.reduceat(np.bitwise_count(words).sum(axis=1, dtype=np.int64).astype(kind) * one, start)
    for k, (i, weight) in enumerate(zip(planes.dim, one)):
        first = start[np.searchsorted(own, i)]  # all planes of the same and later dimensions
        both = np.bitwise_count(words[first:] & words[k]).sum(axis=1, dtype=np.int64).astype(kind) * one[first:]
        products[i, own[own >= i]] += weight * np.add.reduceat(both, start[start >= first] - first)
    return sums, products


def _extremes(size: int):
    """Rows, and least and largest x of each dimension, of a task's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, least, most = 0, None, None
        for batch in batches:
            x = integers(batch.column(0), size)
            if len(x):
                n += len(x)
                least = x.min(0) if least is None else np.minimum(least, x.min(0))
                most = x.max(0) if most is None else np.maximum(most, x.max(0))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()), pa.array(least), pa.array(most)],
                                             names=["dim", "n", "least", "most"])
    return run


def _scatter(planes: Planes, size: int, kind: type):
    """A task's sums (j = -1) and products, each in two parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products, some = np.zeros(size, kind), np.zeros((size, size), kind), False
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK):
                x = integers(batch.column(0).slice(k, BLOCK), size)
                s, p = scatter(planes.pack(x), planes, size, kind)
                sums, products, some = sums + s, products + p, True
        if some:
            i, j = np.triu_indices(size)
            values = [int(v) for v in (*sums, *products[i, j])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.arange(size), i]), pa.int32()), pa.array(np.concatenate([np.full(size, -1), j]), pa.int32()),
                 pa.array([str(v >> _LOW) for v in values]), pa.array([str(v & (1 << _LOW) - 1) for v in values])], names=["i", "j", "high", "low"])
    return run


@dataclass(frozen=True)
class Whitening:
    """What the fit found: rows ``n``, exact sums ``total`` of x, covariance,
    and the components with their eigenvalues, the largest first. A
    component's sign makes its largest entry positive."""

    n: int
    total: tuple[int, ...]
    covariance: np.ndarray
    values: np.ndarray
    components: np.ndarray  # a column each

    @property
    def explained(self) -> np.ndarray:
        trace = float(np.trace(self.covariance))
        return self.values / trace if trace > 0 else np.zeros_like(self.values)

    def spread(self) -> np.ndarray:
        """Square roots of the eigenvalues; nan for a direction without
        variance, which cannot be whitened."""
        least = len(self.covariance) * np.finfo(float).eps * max(float(np.trace(self.covariance)), 0.0)
        return np.sqrt(np.where(self.values > least, self.values, np.nan))


def _rows(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """Usable rows (vec_id, vector) and the length of their vectors."""
    vector = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).filter(usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("size")).count()
    top = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    size = top["size"] if top else 0
    return rows.filter(F.size("vector") == size), size


def fit(rows: DataFrame, size: int) -> Whitening:
    """The whitening of usable ``rows`` with vectors of length ``size``."""
    vectors = rows.select("vector")
    found = (vectors.mapInArrow(_extremes(size), "dim int, n long, least long, most long").groupBy("dim")
             .agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most")).orderBy("dim").collect())  # a row a dimension
    n = found[0]["n"] if found else 0
    if not n:
        return Whitening(0, (), np.zeros((0, 0)), np.zeros(0), np.zeros((0, 0)))
    least, most = np.array([r["least"] for r in found]), np.array([r["most"] for r in found])
    planes = Planes.of(least, most)
    # a task's sums fit 64 bits, or are kept as Python's integers
    kind = np.int64 if 2 * int(planes.bit.max(initial=-1) + 1) + n.bit_length() < 63 else object
    parts = vectors.mapInArrow(_scatter(planes, size, kind), "i int, j int, high string, low string")
    whole = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    sums, products = [0] * size, {}
    for r in parts.groupBy("i", "j").agg(*whole).collect():  # size * (size + 3) / 2 rows
        value = (int(r["high"]) << _LOW) + int(r["low"])
        if r["j"] < 0:
            sums[r["i"]] = value
        else:
            products[r["i"], r["j"]] = value
    v = np.zeros((size, size))
    for (i, j), value in products.items():
        v[i, j] = v[j, i] = (n * value - sums[i] * sums[j]) / n ** 2  # exact up to this division
    values, vectors_ = np.linalg.eigh(v)
    values, vectors_ = np.maximum(values[::-1], 0.0), vectors_[:, ::-1]
    vectors_ = vectors_ * np.sign(vectors_[np.abs(vectors_).argmax(0), np.arange(size)])
    return Whitening(n, tuple(s + n * int(m) for s, m in zip(sums, least)), v, values, vectors_)


def _whiten(w: Whitening, size: int, count: int):
    project = w.components[:, :count] / w.spread()[:count]
    total = np.array(w.total, dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK):
                part = batch.slice(k, BLOCK)
                x = integers(part.column(1), size)
                # x - S // n is small, n times it is not: the rest of the division is added after
                near = x - np.array([t // w.n for t in total], np.int64)
                rest = np.array([t % w.n for t in total], np.int64)
                white = (near - rest / w.n) @ project
                if int(np.abs(near).max(initial=0) + 1) ** 2 * w.n ** 2 * size < 1 << 63:
                    deviation = ((w.n * near - rest) ** 2).sum(axis=1).tolist()
                else:
                    deviation = [sum(d * d for d in row) for row in (w.n * near.astype(object) - rest.astype(object)).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([d if d < 1 << 63 else None for d in deviation], pa.int64()),
                     pa.array([str(d) for d in deviation]),
                     pa.ListArray.from_arrays(np.arange(0, white.size + 1, count, dtype=np.int32), pa.array(white.ravel(), from_pandas=False))],
                    names=["vec_id", "deviation", "exact_deviation", "white"])
    return run


def _spread_error(count: int):
    """A task's sums of the products of whitened entries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count + 1, count + 1))
        for batch in batches:
            white = np.nan_to_num(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, count))
            white = np.hstack([white, np.ones((len(white), 1))])
            total += white.T @ white
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], names=["i", "j", "s"])
    return run


def whiten(df: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, Whitening, float | None]:
    """Rows (vec_id, deviation, exact_deviation, white) of all usable rows of
    ``df``, the fitted whitening, and the largest absolute entry of the
    whitened rows' covariance minus the identity.

    ``white`` has the first ``components`` whitened coordinates (all, if the
    vectors are shorter). ``deviation`` is the sum over dimensions of
    (n * x - S) squared, null where a long has no room for it;
    ``exact_deviation`` is the same number as text.

    Null vectors and vectors with a null, non-finite or over-large (2**52)
    entry take no part; of vectors of several lengths those of the most
    frequent one do (of ties the longest). A null id stays null, rows that
    repeat an id or a vector count each. A direction without variance has nan
    coordinates, and the error is over the others (None if there is none). An
    empty table, or one of empty vectors, gives no rows. Other columns of
    ``df`` are not read.
    """
    spark = df.sparkSession
    rows, size = _rows(df, id_col, vector_col)
    schema = "vec_id long, deviation long, exact_deviation string, white array<double>"
    w = fit(rows, size) if size else Whitening(0, (), np.zeros((0, 0)), np.zeros(0), np.zeros((0, 0)))
    if not w.n:
        return spark.createDataFrame([], schema), w, None
    count = min(components, size)
    white = shared_table(spark, rows.mapInArrow(_whiten(w, size, count), schema), "whitened")
    sums = white.select("white").mapInArrow(_spread_error(count), "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    s = np.zeros((count + 1, count + 1))
    for r in sums:
        s[r["i"], r["j"]] = r["s"]
    s /= w.n
    off = s[:count, :count] - np.outer(s[count, :count], s[count, :count]) - np.eye(count)
    known = np.isfinite(w.spread()[:count])
    return white, w, float(np.abs(off[np.ix_(known, known)]).max()) if known.any() else None


@register("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each usable vector and component up to 8."""
    rows, w, error = whiten(read_table(spark, sf_dir, "embeddings"))
    explained = F.array(*map(F.lit, map(float, w.explained[:8]))) if w.n else F.array().cast("array<double>")
    return (rows.select("vec_id", "deviation", "exact_deviation", F.posexplode("white").alias("at", "value"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation",
                    F.when(~F.isnan("value"), F.col("value")).alias("whitened"), F.element_at(explained, F.col("at") + 1).alias("explained"),
                    F.lit(error).cast("double").alias("identity_error"), "exact_deviation"))
