"""Prefix trie of conversations by the Euler-tour technique.

A node is a distinct sequence of first turns. Each node gives two arcs, into
it and out of it; an arc's successor is the arc into the first child, else the
arc out, and from there the arc into the next sibling, else that out of the
parent. The tour of all arcs is a linked list, which is ranked by contraction;
at the arcs' positions, prefix sums of the leaves' and the nodes' weights give
every subtree's sum as that at the arc out minus that at the arc in.

Scale. A node is found by two 64-bit sums of position-keyed hashes of its
turns: sums, so that a conversation of any length is summed by ranges
(``plans.prefix``) and no conversation lies in one task. Common first turns
are counted by partial aggregates. Siblings are linked inside 4,096 hashed
buckets of a parent and buckets by their first nodes, so the children of a
node that starts a third of all conversations are many groups. A round of the
contraction is one shuffle by arc: each arc whose hash of the round is larger
than its successor's is sent to it, and an arc that is not sent itself takes
in the one that comes. A third of the arcs goes in a round; the last few
(``small``) are walked in one task, then the rounds are undone in reverse,
each one join. Every step is written, so nothing is computed twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mesura.llm.common import read_table, register
from mesura.plans.prefix import Scratch, running

BUCKETS = 4096  # of the children of a node
CHUNK = 12  # bits: conversation ids of one chunk of a digest share all others
SHARED, TURNS = 5, 9  # a conversation takes up to 8 turns of the one before it that 5 divides


def _key(depth: Column, a: Column, b: Column) -> Column:
    return F.md5(F.concat_ws(" ", depth, a, b))


def rebuilt_turns(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: turns (conv, depth, turns, bytes, x, y) with
    two hashes of role and text, and lengths (conv, turns)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.octet_length(text).cast("long").alias("bytes"),
        F.xxhash64(role, text).alias("x"), F.xxhash64(F.lit("second"), role, text).alias("y"),
        F.monotonically_increasing_id().alias("spread")).filter("conv is not null")  # so that rows that repeat are several ranges
    ranked = scratch.write(running(rows, ["conv"], ["turn", "x", "y", "spread"], {"nth": F.lit(1)}, scratch), "ranked")
    lengths = ranked.groupBy("conv").agg(F.max("nth").alias("n"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % TURNS).cast("long")
    convs = lengths.select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % SHARED).alias("base"))
    base = lengths.select(F.col("conv").alias("base"), F.col("n").alias("m"))
    convs = convs.join(base, "base", "left").withColumn("taken", F.least("h", F.coalesce("m", F.lit(0))))
    convs = scratch.write(convs.withColumn("turns", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).select("conv", "base", "h", "taken", "turns"), "convs")
    own = (ranked.join(convs, "conv").filter("nth > h")
           .select("conv", (F.col("taken") + F.col("nth") - F.col("h")).alias("depth"), "turns", "bytes", "x", "y"))
    first = ranked.filter(F.col("nth") < TURNS).select(F.col("conv").alias("base"), "nth", "bytes", "x", "y")
    taken = (convs.filter("taken > 0").join(first, "base").filter("nth <= taken")
             .select("conv", F.col("nth").alias("depth"), "turns", "bytes", "x", "y"))
    return own.union(taken), convs.select("conv", "turns")


def rank_list(arcs: DataFrame, scratch: Scratch, small: int = 4096) -> DataFrame:
    """Rows (arc, place) of the linked list ``arcs`` (arc, next; null at the
    end), places from 0."""
    state, rounds, level = scratch.write(arcs.select("arc", "next", F.lit(1).cast("long").alias("steps")), "arcs"), [], 0
    now = state
    while state.count() > small:
        sent = F.coalesce(F.xxhash64("arc", F.lit(level)) > F.xxhash64("next", F.lit(level)), F.lit(False)) & F.col("next").isNotNull()
        keyed = state.select(
            F.when(sent, F.col("next")).otherwise(F.col("arc")).alias("key"), F.when(~sent, F.col("next")).alias("next"),
            F.when(~sent, F.col("steps")).alias("steps"), F.when(sent, F.col("arc")).alias("by"), F.when(sent, F.col("steps")).alias("off"))
        met = scratch.write(keyed.groupBy("key").agg(*[F.max(c).alias(c) for c in ("next", "steps", "by", "off")]), f"round{level}")
        if level == 0:
            scratch.drop(now)
        own = F.col("steps").isNotNull()
        state = met.select(F.coalesce("by", "key").alias("arc"), F.when(own, F.col("next")).otherwise(F.col("key")).alias("next"),
                           (F.coalesce("steps", F.lit(0)) + F.coalesce("off", F.lit(0))).alias("steps"))
        rounds.append(met)
        level += 1
    known = scratch.write(state.coalesce(1).mapInArrow(_walk, "arc long, place long"), "walked")
    for met in reversed(rounds):
        gone = met.filter("steps is not null and by is not null").select(F.col("key").alias("gone"), F.col("by").alias("arc"), "off")
        whole = known.union(gone.join(known, "arc").select("gone", F.col("place") + F.col("off")))
        after = scratch.write(whole, "places")
        scratch.drop(known)
        scratch.drop(met)
        known = after
    return known


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of a short list's arcs."""
    follow: dict[int, tuple[int | None, int]] = {}
    for batch in batches:
        follow.update(zip(batch.column(0).to_pylist(), zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())))
    at, place, arcs, places = next(iter(follow.keys() - {x for x, _ in follow.values()}), None), 0, [], []
    while at is not None:
        arcs.append(at)
        places.append(place)
        at, steps = follow[at]
        place += steps
    yield pa.RecordBatch.from_arrays([pa.array(arcs, pa.int64()), pa.array(places, pa.int64())], names=["arc", "place"])


def _linked(nodes: DataFrame) -> DataFrame:
    """``nodes`` with parent, its conversation, next sibling, first child and
    number of children."""
    kids = nodes.filter("parent_key is not null").withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).cast("int"))
    of = ["parent_key", "bucket"]
    firsts = kids.groupBy(*of).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    siblings = Window.partitionBy("parent_key")  # at most a row a bucket
    firsts = firsts.select(*of, "first", F.lead("first").over(siblings.orderBy("bucket")).alias("later"),
                           F.row_number().over(siblings.orderBy("bucket")).alias("nth"), F.sum("n").over(siblings).alias("children"))
    parents = nodes.select(F.col("key").alias("parent_key"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    firsts = firsts.join(parents, "parent_key")
    kids = kids.select("id", *of, F.lead("id").over(Window.partitionBy(*of).orderBy("id")).alias("sibling"))
    kids = kids.join(firsts, of).select("id", "parent", "parent_conv_id", F.coalesce("sibling", "later").alias("sibling"))
    tops = firsts.filter("nth = 1").select(F.col("parent").alias("id"), F.col("first").alias("child"), "children")
    return nodes.drop("parent_key").join(kids, "id", "left").join(tops, "id", "left")


def trie(conversations: DataFrame, small: int = 4096) -> tuple[DataFrame, DataFrame]:
    """The nodes of the prefix trie of the rebuilt conversations, and the
    conversations that end at each.

    Nodes: (key, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens), the root included; ends: (key, conv). Conversations: turns by
    number, null first, turns of one number in the order of a hash of role and
    text; a null role or text is empty. Conversation c is rebuilt as the first
    h turns of conversation c - c % 5 and its own turns after its first h, h
    being crc32 of its decimal id modulo 9. Rows with a null id take no part;
    rows that repeat are turns of their own. An empty table gives no nodes.
    ``small`` is the length of the list that one task may walk.
    """
    spark = conversations.sparkSession
    scratch = Scratch(spark, "trie")
    turns, convs = rebuilt_turns(conversations, scratch)
    term = lambda c: F.xxhash64(c, "depth").cast("decimal(20,0)")
    summed = running(turns, ["conv"], ["depth"], {"a": term("x"), "b": term("y")}, scratch)
    root = F.md5(F.lit("0 0 0"))
    keyed = scratch.write(summed.select(
        "conv", "depth", "bytes", (F.col("depth") == F.col("turns")).alias("last"), _key(F.col("depth"), F.col("a"), F.col("b")).alias("key"),
        F.when(F.col("depth") == 1, root).otherwise(_key(F.col("depth") - 1, F.col("a") - term("x"), F.col("b") - term("y"))).alias("parent_key")), "keyed")
    counted = [F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")]
    nodes = keyed.groupBy("key", "parent_key").agg(*counted, F.max("depth").alias("depth"), F.max("bytes").alias("bytes"))
    top = convs.agg(*counted).filter("n_convs > 0").select(root.alias("key"), F.lit(None).cast("string").alias("parent_key"), "conv_id", "n_convs",
                                                           F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"))
    nodes = scratch.write(nodes.union(top.select(*nodes.columns)).withColumn("id", F.monotonically_increasing_id()), "nodes")
    linked = scratch.write(_linked(nodes), "linked")
    into, out = F.col("id") * 2, F.col("id") * 2 + 1
    arcs = linked.select(into.alias("arc"), F.coalesce(F.col("child") * 2, out).alias("next")).union(
        linked.select(out.alias("arc"), F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1).alias("next")))
    places = rank_list(arcs, scratch, small)
    weights = linked.select(into.alias("arc"), F.col("child").isNull().cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    along = running(places.join(weights, "arc", "left").fillna(0, ["leaf", "saved"]), [], ["place"], {"leaves": F.col("leaf"), "saving": F.col("saved")}, scratch)
    at = lambda odd, c: F.max(F.when(F.col("arc") % 2 == odd, F.col(c)))
    subtrees = along.groupBy(F.expr("arc div 2").alias("id")).agg(
        *[(at(1, total) - at(0, total) + at(0, own)).alias(name) for name, total, own in (("n_leaves", "leaves", "leaf"), ("saved_tokens", "saving", "saved"))])
    whole = linked.join(subtrees, "id").select("key", "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("children", F.lit(0)).cast("long").alias("n_children"),
                                               "n_leaves", "saved_tokens")
    ends = keyed.filter("last").select("key", "conv").union(convs.filter("turns = 0").select(root, "conv"))
    return whole, ends


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 for each key of sorted rows (key, chunk, ids)."""
    key, digest = None, hashlib.sha256()
    for batch in batches:
        keys, found = [], []
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(2)):
            if k != key:
                if key is not None:
                    keys.append(key)
                    found.append(digest.hexdigest())
                key, digest = k, hashlib.sha256(ids.as_py().encode())
            else:
                digest.update(b"," + ids.as_py().encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(found, pa.string())], names=["key", "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], names=["key", "ends_sha256"])


def digests(ends: DataFrame) -> DataFrame:
    """Rows (key, ends_sha256): SHA-256 of the ids that end at a node, in
    order, comma-joined. A digest takes its text from the front to the back, so
    a node's ids pass through one task; they are sorted and joined before, in
    chunks of at most 4,096, and the task holds one chunk."""
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    chunks = ends.groupBy("key", F.shiftright("conv", CHUNK).alias("chunk")).agg(ids.alias("ids"))
    return chunks.repartition("key").sortWithinPartitions("key", "chunk").mapInArrow(_digests, "key string, ends_sha256 string")


OP12_SQL = r"""
WITH c AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT c, list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(c AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT)),
        lambda r, d: list_reduce([xor(r, d)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda s, z: xor(s >> 1, (s & 1) * 3988292384))) AS r FROM c),
t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS k FROM conversations WHERE conv_id IS NOT NULL),
g AS (SELECT c, CAST(xor(r, 4294967295::BIGINT) % 9 AS BIGINT) AS h, c - c % 5 AS b FROM h),
m AS (SELECT g.c, g.h, g.b, least(g.h, coalesce(n.n, 0)) AS s FROM g LEFT JOIN (SELECT c, max(k) AS n FROM t GROUP BY c) n ON n.c = g.b),
u AS (SELECT m.c, t.k AS d, t.role, t.text FROM m JOIN t ON t.c = m.b AND t.k <= m.h
      UNION ALL SELECT m.c, m.s + t.k - m.h, t.role, t.text FROM m JOIN t ON t.c = m.c AND t.k > m.h),
p AS (SELECT c, d, text, list(role || chr(1) || md5(text)) OVER (PARTITION BY c ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS q FROM u),
e AS (SELECT c, d, sha256(array_to_string(q, chr(2))) AS x, octet_length(encode(text)) AS w, lag(sha256(array_to_string(q, chr(2)))) OVER (PARTITION BY c ORDER BY d) AS y FROM p
      UNION ALL SELECT c, 0, 'root', 0, NULL FROM c),
v AS (SELECT x, max(coalesce(y, CASE WHEN d > 0 THEN 'root' END)) AS y, max(d) AS d, min(c) AS c, count(*) AS n, max(w) AS w FROM e GROUP BY x),
k AS (SELECT y AS x, count(*) AS n FROM v WHERE y IS NOT NULL GROUP BY y),
a AS (SELECT DISTINCT z.x AS top, e.x FROM e JOIN e z ON z.c = e.c AND z.d <= e.d),
s AS (SELECT a.top AS x, count(*) FILTER (WHERE k.n IS NULL) AS leaves, sum((v.n - 1) * v.w) AS saved FROM a JOIN v ON v.x = a.x LEFT JOIN k ON k.x = a.x GROUP BY a.top),
f AS (SELECT x, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM (SELECT c, x FROM e QUALIFY row_number() OVER (PARTITION BY c ORDER BY d DESC) = 1) GROUP BY x)
SELECT v.c AS conv_id, CAST(v.d AS BIGINT) AS depth, o.c AS parent_conv_id, CAST(v.n AS BIGINT) AS n_convs, CAST(coalesce(k.n, 0) AS BIGINT) AS n_children,
  CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(f.ids, '')) AS ends_sha256
FROM v JOIN s ON s.x = v.x LEFT JOIN k ON k.x = v.x LEFT JOIN f ON f.x = v.x LEFT JOIN v o ON o.x = v.y
"""


@register("op12_prefix_trie", OP12_SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, ends = trie(read_table(spark, sf_dir, "conversations"))
    found = nodes.join(digests(ends), "key", "left").drop("key")
    return found.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))
