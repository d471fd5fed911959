"""Near-duplicate documents by SetSketch registers, banding and verification.

Method. A document's set is its distinct two-word shingles. Each register of
its sketch is an exponentially spaced truncated minimum (SetSketch):
``floor(1 - log_b h)`` of the least exponential variate ``h`` that the
document's shingles draw for it, clipped to 0..q+1. The registers of a union
are the register-wise maxima of the parts, and equal with a probability that
follows the Jaccard similarity, so bands of register values find candidates.
A candidate pair's similarity is judged jointly from the two set sizes and
the counts of larger, smaller and equal registers by likelihood; what cannot
have the wanted similarity goes, the rest is confirmed on the full sets.

Scale. Documents with equal sets are one class (its least id stands for it),
so copies never meet in pairs. In a band bucket every member is first
compared with the bucket's least member, the pivot: a group of s near copies
costs s comparisons a band at most, not s squared. Members that are then
still apart from the pivot's component are compared, on the full sets, with
all of that component and with each other; members of one component are not
compared. So of two members of a bucket that end in different components at
least one was apart and has met the other: no link between components is
lost. These comparisons run in blocks of bounded characters, many blocks a
task, and only links leave a block. Where the rows of one key (a component, the
hub of a star) are joined with a row of that key, they are joined through 1,024
cells of the key, so that no task gets all of them. Components are found by alternating large-star and
small-star contraction over DataFrames. Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mesura.llm.common import mix64, read_table, register, shared_table


@dataclass(frozen=True)
class Params:
    """``groupings`` times the registers are dealt to bands of ``rows``, each
    time in another order. At similarity 0.8 a pair shares no band of the
    default 114 with a probability of 3e-10 (4e-12 at 0.82). ``base`` and
    ``q`` are the spacing and the truncation of the registers, ``rate`` the
    rate of the exponential variates. ``odds`` is the log-likelihood ratio
    against the threshold at which a candidate is given up unread."""

    threshold: float = 0.8
    registers: int = 400
    rows: int = 7
    groupings: int = 2
    base: float = 1.001
    q: int = 65534
    rate: float = 20.0
    odds: float = 20.0
    seed: int = 20240817

    @property
    def bands(self) -> int:
        return self.groupings * (self.registers // self.rows)


_ODD = 0x9E3779B97F4A7C15 | 1
_TABLES: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64 and of its inverse, n at least."""
    if not _TABLES or len(_TABLES[0]) < n:
        n = max(n, 1 << 16)
        for k, x in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            steps = np.full(n, x, np.uint64)
            steps[0] = 1
            _TABLES[k:k + 1] = [np.cumprod(steps, dtype=np.uint64)]
    return _TABLES[0], _TABLES[1]


_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))  # of a byte
_VALUE[65:91] = _VALUE[97:123]  # A-Z as a-z
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_VALUE[_BLANK] = 0


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words between ASCII white space, in order: each a
    polynomial of its bytes, from one running sum over the text."""
    b = np.frombuffer(data, np.uint8)
    blank = _BLANK[b]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, np.uint64)
    powers, inverse = _powers(len(b))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUE[b] * powers[:len(b)], dtype=np.uint64)])
    return mix64((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the two-word shingles of ``text``: A-Z
    lower-cased, words between ASCII white space. One word: that word alone;
    none, or a null text: empty."""
    h = word_hashes((text or "").encode())
    if len(h) < 2:
        return mix64(h ^ np.uint64(0x5851F42D4C957F2D))
    g = mix64(h[:-1] * np.uint64(_ODD) + (h[1:] ^ (h[1:] >> np.uint64(29))))
    g.sort()
    return g[np.concatenate([[True], g[1:] != g[:-1]])]


class SetSketch:
    """Registers of a set; ``merge`` gives those of the union."""

    def __init__(self, p: Params):
        rng = np.random.default_rng(p.seed)
        self.p, self.m = p, p.registers
        self.mul = rng.integers(0, 1 << 31, self.m).astype(np.uint32) * np.uint32(2) + np.uint32(1)
        self.add = rng.integers(0, 1 << 32, self.m, dtype=np.uint64).astype(np.uint32)
        whole = self.m // p.rows * p.rows
        self.order = np.concatenate([np.arange(whole) if k == 0 else rng.permutation(self.m)[:whole] for k in range(p.groupings)])

    def registers(self, s: np.ndarray) -> np.ndarray:
        least = np.full(self.m, 0xFFFFFFFF, np.uint32)
        s32 = (s >> np.uint64(32)).astype(np.uint32)
        for k in range(0, len(s32), 512):  # blocks that stay in the cache
            x = np.multiply.outer(self.mul, s32[k:k + 512])
            x += self.add[:, None]
            np.minimum(least, x.min(axis=1), out=least)
        h = -np.log1p(-(least + 0.5) / 2.0 ** 32) / self.p.rate
        return np.clip(np.floor(1 - np.log(h) / np.log(self.p.base)), 0, self.p.q + 1).astype(np.uint16)

    @staticmethod
    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.maximum(a, b)

    def band_keys(self, registers: np.ndarray) -> np.ndarray:
        """One 64-bit key a band for rows of registers (n x m)."""
        x = registers[:, self.order].reshape(len(registers), self.p.bands, self.p.rows).astype(np.uint64)
        key = np.broadcast_to(np.arange(1, self.p.bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), x.shape[:2])
        for j in range(self.p.rows):
            key = mix64(key + x[:, :, j] + np.uint64(1))
        return key


def log_likelihood(j: np.ndarray, u: np.ndarray, more: np.ndarray, less: np.ndarray, same: np.ndarray, b: float) -> np.ndarray:
    """Joint log-likelihood of similarity ``j`` when the first set has the
    share ``u`` of both sizes and its registers are larger, smaller and equal
    so many times."""
    p = lambda x: -np.log1p(-x * (b - 1) / b) / np.log(b)
    v = 1 - u
    up, down = p(np.maximum(u - v * j, 0)), p(np.maximum(v - u * j, 0))
    tiny = 1e-12
    return more * np.log(up + tiny) + less * np.log(down + tiny) + same * np.log(np.maximum(1 - up - down, 0) + tiny)


def similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, base: float) -> tuple[np.ndarray, tuple]:
    """Most likely similarity of register rows ``a`` and ``b`` with set sizes
    ``na`` and ``nb``, by golden-section search of the concave likelihood."""
    more, less = (a > b).sum(1).astype(float), (a < b).sum(1).astype(float)
    data = (na / (na + nb), more, less, a.shape[1] - more - less)
    lo, hi = np.zeros(len(a)), np.minimum(na, nb) / np.maximum(na, nb)
    g = (5 ** 0.5 - 1) / 2
    for _ in range(40):
        x, y = hi - g * (hi - lo), lo + g * (hi - lo)
        left = log_likelihood(x, *data, base) > log_likelihood(y, *data, base)
        hi, lo = np.where(left, y, hi), np.where(left, lo, x)
    return (lo + hi) / 2, data


def _sketches(p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = SetSketch(p)
        for batch in batches:
            n, f1, f2, regs = [], [], [], []
            for t in batch.column(1):
                s = shingle_set(t.as_py())
                d = xxhash.xxh3_128_intdigest(s.tobytes())
                n.append(len(s))
                f1.append((d >> 64) - (1 << 63))
                f2.append((d & 0xFFFFFFFFFFFFFFFF) - (1 << 63))
                regs.append(sketch.registers(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(regs, pa.binary())],
                names=["id", "n", "f1", "f2", "regs"])
    return run


def _bands(p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = SetSketch(p)
        for batch in batches:
            for k in range(0, batch.num_rows, 2000):
                part = batch.slice(k, 2000)
                regs = np.frombuffer(b"".join(x.as_py() for x in part.column(1)), np.uint16).reshape(part.num_rows, sketch.m)
                keys = sketch.band_keys(regs)
                ids = np.repeat(part.column(0).to_numpy(zero_copy_only=False), p.bands)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(ids, pa.int64())], names=["bucket", "id"])
    return run


def _likely(p: Params):
    """Pairs that the likelihood does not rule out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = p.registers
        for batch in batches:
            keep = []
            for k in range(0, batch.num_rows, 2000):
                part = batch.slice(k, 2000)
                a, b = (np.frombuffer(b"".join(x.as_py() for x in part.column(i)), np.uint16).reshape(-1, m) for i in (3, 5))
                na, nb = (part.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (2, 4))
                best, data = similarity(a, b, na, nb, p.base)
                top = np.minimum(na, nb) / np.maximum(na, nb)
                short = log_likelihood(best, *data, p.base) - log_likelihood(np.minimum(p.threshold, top), *data, p.base)
                keep.append((100 * np.minimum(na, nb) >= round(100 * p.threshold) * np.maximum(na, nb)) & ((best >= p.threshold) | (short <= p.odds)))
            if keep:
                yield batch.select(["a", "b"]).filter(pa.array(np.concatenate(keep)))
    return run


def _confirm(p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        percent = round(100 * p.threshold)
        for batch in batches:
            keep = []
            for ta, tb in zip(batch.column(2), batch.column(3)):
                tb = tb.as_py()
                if last[0] != tb:
                    last = (tb, shingle_set(tb))
                x, y = shingle_set(ta.as_py()), last[1]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _blocks(p: Params):
    """Links between the rows of ``left`` and ``right`` of each block, exact."""
    percent = round(100 * p.threshold)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out_a, out_b = [], []
        names = ("main", "i", "j")
        own, other = (list(zip(*(t[c].to_pylist() for c in names))) for t in (left, right))
        rows: dict[tuple, tuple[list[int], list[int]]] = {}
        for k, key in enumerate(own):
            rows.setdefault(key, ([], []))[0].append(k)
        for k, key in enumerate(other):
            if key in rows:
                rows[key][1].append(k)
        xs, xc, yd, yc = (t[c].to_numpy() for t, c in ((left, "id"), (left, "comp"), (right, "id"), (right, "comp")))
        for of_x, of_y in rows.values():
            if not of_y:
                continue
            sets = [shingle_set(right["text"][k].as_py()) for k in of_y]
            size = np.array([len(x) for x in sets])
            signs, place = np.unique(np.concatenate(sets), return_inverse=True)
            starts = np.cumsum(size) - size
            ids, comp = yd[of_y], yc[of_y]
            for k in of_x:
                x = shingle_set(left["text"][k].as_py())
                at = np.searchsorted(signs, x)
                at = at[(at < len(signs)) & (signs[np.minimum(at, len(signs) - 1)] == x)]
                mark = np.zeros(len(signs), np.int64)
                mark[at] = 1
                both = np.add.reduceat(mark[place], starts)
                near = ids[(100 * both >= percent * (len(x) + size - both)) & (comp != xc[k])]
                out_a.append(np.maximum(near, xs[k]))
                out_b.append(np.minimum(near, xs[k]))
        if not out_a:
            return schema.empty_table()
        return pa.table([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], schema=schema)
    return run


def _spread(rows: DataFrame, key: str, by: str, side: DataFrame, cells: int = 1024) -> DataFrame:
    """``rows`` joined on ``key`` with ``side``, which has one row a key, by
    way of the key's cells: no key's rows meet in one task."""
    dealt = rows.withColumn("__cell", F.pmod(F.xxhash64(by), F.lit(cells)).cast("int"))
    told = dealt.select(key, "__cell").distinct().join(side, key)
    return dealt.join(told, [key, "__cell"]).drop("__cell")


def _apart(spark: SparkSession, members: DataFrame, comps: DataFrame, texts: DataFrame, p: Params, block: int = 1_000_000) -> DataFrame:
    """Links of the members that are apart from the component of their
    bucket's pivot, with that component and with each other, written. A block
    has texts of about ``block`` characters on either side."""
    state = members.join(comps, "id", "left").select("bucket", "id", "pivot", F.coalesce("comp", "id").alias("comp"))
    of_pivot = state.filter("id = pivot").select("bucket", F.col("comp").alias("main"))
    apart = state.join(of_pivot, "bucket").filter("comp != main")
    many = apart.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    # a lone member apart from a lone pivot has met it already
    grown = comps.select(F.col("comp").alias("main"), F.lit(True).alias("grown")).distinct()
    near = (apart.join(many, "bucket").join(grown, "main", "left").filter("n > 1 or grown")
            .select("main", "id", "comp").distinct())
    size = texts.groupBy("id").agg(F.sum("chars").alias("chars"))
    near = shared_table(spark, near.join(size, "id"), "apart")
    cut = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / block)).cast("int")
    mains = near.groupBy("main").agg(F.count(F.lit(1)).alias("nx"), F.sum("chars").alias("cx"))
    rest = _spread(comps.withColumnRenamed("comp", "main"), "main", "id", mains.select("main")).withColumn("comp", F.col("main"))
    right = shared_table(spark, near.union(rest.join(size, "id").select(*near.columns)), "near")
    sizes = (right.groupBy("main").agg(F.count(F.lit(1)).alias("ny"), F.sum("chars").alias("cy")).join(mains, "main")
             .select("main", "nx", "ny", cut("cx").alias("i_cuts"), cut("cy").alias("j_cuts")))
    # so many that a task's share of both sides is some blocks, whatever the largest component
    dealt_chars = (sizes.agg(F.sum(F.col("nx") * F.col("j_cuts") + F.col("ny") * F.col("i_cuts"))).first()[0] or 0) * (
        right.agg(F.coalesce(F.avg("chars"), F.lit(0.0))).first()[0])
    bundles = max(1, int(dealt_chars // (2 * block)))
    bundle = F.pmod(F.xxhash64("main", "i", "j"), F.lit(bundles)).alias("bundle")

    def dealt(df: DataFrame, own: str, other: str, seed: int) -> DataFrame:
        at = F.pmod(F.xxhash64("id", F.lit(seed)), F.col(f"{own}_cuts")).cast("int")
        return _spread(df, "main", "id", sizes).select("main", "id", "comp", at.alias(own), F.explode(F.sequence(F.lit(0), F.col(f"{other}_cuts") - 1)).alias(other))

    x, y = dealt(near, "i", "j", 1).select("main", "id", "comp", "i", "j"), dealt(right, "j", "i", 2).select("main", "id", "comp", "j", "i")
    told = lambda df: df.join(texts, "id").select(bundle, "main", "i", "j", "id", "comp", "text")
    # both sides of a cogroup must not share columns
    renamed = told(y).select(*(F.col(c).alias(c + "_") for c in ("bundle", "main", "i", "j", "id", "comp", "text")))
    run = _blocks(p)

    def links(left: pa.Table, right: pa.Table) -> pa.Table:
        return run(left, right.rename_columns([c.removesuffix("_") for c in right.column_names]))

    found = told(x).groupBy("bundle").cogroup(renamed.groupBy("bundle_")).applyInArrow(links, "a long, b long")
    return shared_table(spark, found.distinct(), "links")


def connected(spark: SparkSession, links: DataFrame, name: str = "stars") -> DataFrame:
    """Components of links (a, b): rows (id, comp) with the least id of each
    node's component, by alternating large-star and small-star contraction.
    Nodes without links are not in the result. Every round is written, so no
    plan grows with the number of rounds."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    edges = shared_table(spark, edges, name)
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("mv")).select("u", F.least("u", "mv").alias("m"))
        large = _spread(both, "u", "v", least).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _spread(large, "u", "v", low).filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = shared_table(spark, small.union(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct(), name)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("comp")).union(
                edges.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct())
        before = tuple(now)


def _links(spark: SparkSession, pairs: DataFrame, reps: DataFrame, texts: DataFrame, p: Params, name: str) -> DataFrame:
    """Confirmed pairs among candidate ``pairs`` (a, b), written."""
    sized = (pairs.join(reps.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra")), "a")
             .join(reps.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb")), "b")
             .select("a", "b", "na", "ra", "nb", "rb").mapInArrow(_likely(p), "a long, b long"))
    read = (sized.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb"))
    return shared_table(spark, read.mapInArrow(_confirm(p), "a long, b long"), name)


def near_duplicates(docs: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one for each row of ``docs``.

    Null or empty texts: n_shingles 0, linked with nothing. Rows that repeat an
    id are one node with several texts: it is linked if any of them is, and
    each row is returned. A null id takes no part in links: component_id is
    null and kept is true. Other columns of ``docs`` are not read, whatever
    their names. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketched = shared_table(spark, rows.mapInArrow(_sketches(p), "id long, n long, f1 long, f2 long, regs binary"), "sketches")
    full = sketched.filter("n > 0 and id is not null")
    classes = full.groupBy("f1", "f2").agg(F.min("id").alias("rep"))
    # rows that repeat an id and a text are one member, before any bucket
    reps = (full.join(classes.select(F.col("rep").alias("id"), "f1", "f2"), ["id", "f1", "f2"], "left_semi")
            .dropDuplicates(["id", "f1", "f2"]).select("id", "n", "regs"))
    if not full.groupBy("id").count().filter("count > 1").isEmpty():
        same = [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit("second"), "text").alias("t2")]
        rows = rows.groupBy("id", *same).agg(F.first("text").alias("text")).select("id", "text")

    keys = reps.select("id", "regs").mapInArrow(_bands(p), "bucket long, id long")
    shared = (keys.groupBy("bucket").agg(F.min("id").alias("pivot"), F.max("id").alias("last"), F.count(F.lit(1)).alias("size"))
              .filter("last != pivot").select("bucket", "pivot", "size"))
    members = shared_table(spark, keys.join(shared, "bucket"), "buckets")
    # sketches and texts of the members alone: what later rounds read
    involved = members.select("id").distinct()
    reps = shared_table(spark, reps.join(involved, "id", "left_semi"), "reps")
    texts = shared_table(spark, rows.join(involved, "id", "left_semi").withColumn("chars", F.length("text")), "texts")

    pairs = members.filter("id != pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
    links = _links(spark, pairs, reps, texts, p, "links")
    comps = connected(spark, links)
    links = links.union(_apart(spark, members, comps, texts, p))
    comps = connected(spark, links)

    # a class is reached through its least id; an id with several texts links their classes
    if_many = full.join(classes, ["f1", "f2"]).filter("id != rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    several = full.groupBy("id").agg(F.min("f1").alias("x"), F.max("f1").alias("y")).filter("x != y").select("id")
    twice = if_many.join(several, F.col("a") == F.col("id"), "left_semi")
    if not twice.isEmpty():
        comps = connected(spark, links.union(twice))
    classes = classes.join(comps, classes["rep"] == comps["id"], "left").select("f1", "f2", F.coalesce("comp", "rep").alias("comp"))
    return (sketched.join(classes, ["f1", "f2"], "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.when((F.col("n") == 0) | F.col("id").isNull(), F.col("id")).otherwise(F.col("comp")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 2 THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) ELSE ws END) AS g FROM w),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b WHERE 100 * p.n >= 80 * (x.n + y.n - p.n)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS c FROM r GROUP BY a)
SELECT w.doc_id, CAST(coalesce(z.n, 0) AS BIGINT) AS n_shingles, c.c AS component_id, w.doc_id = c.c AS kept
FROM w LEFT JOIN z USING (doc_id) LEFT JOIN c ON c.a = w.doc_id
"""


@register("op8_minhash_near_dedup", OP8_SQL)
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
