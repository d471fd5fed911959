"""Best-fit packing of tokenised documents under several capacities.

A document's token ids are cut into pieces of at most the sequence length, and
pieces are packed whole. A sequence has three capacities: tokens, documents
and attention cost (the sum of squared piece lengths). Pieces go from long to
short; each takes, among the open sequences with room in every capacity, the
one with the least weighted norm of what would be left (``rule="norm"``) or
the one whose residual points most along the piece's demand (``rule="dot"``).

Scale. All a piece demands follows from its length, so the decision runs over
the histogram of lengths: at most ``tokens`` entries however many documents
there are, and equal sequences are filled together. The result is a bounded
table of slots: ranks of a length -> sequences and offsets. Each piece learns
its rank among the pieces of its length from a window inside hashed buckets
plus the counts of the buckets before, so no length, however common, lies in
one task, and finds its slot by binary search.
"""

from __future__ import annotations

import math
import os
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mesura.llm.common import read_table, register, shared_table, tokenizer_file


@dataclass(frozen=True)
class Capacity:
    """Of one sequence. By default documents and cost allow whatever the
    tokens allow, so that sequences are as few as can be."""

    tokens: int = 4096
    docs: int = 4096
    cost: int = 4096 ** 2

    @property
    def piece(self) -> int:
        """The longest piece that fits alone."""
        return max(1, min(self.tokens, math.isqrt(self.cost)))


def _byte_signs() -> dict[int, str]:
    """The sign that byte-level vocabularies write for each byte: itself, if
    it is a visible Latin-1 sign, else the next code point from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return {b: chr(b) if b in shown else chr(next(other)) for b in range(256)}


#: ASCII marks without the apostrophe, which can start a piece of letters.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class ChunkIds(dict):
    """Token ids, as bytes, of a run of non-blank characters.

    The tokenizer drops white space and never joins across it, so a text's
    ids are those of its runs in order; each run is encoded once while it
    stays in the cache. A run of letters below U+0180 is one word, whose ids
    the tokenizer's model gives without its other steps. Letters that end in
    one below U+0180, with marks behind, are the letters and the marks; a later
    letter may be normalised into a letter and a mark, which then join the marks
    behind it. Other runs take the whole tokenizer. Two generations bound the
    cache.
    """

    def __init__(self, file: str, most: int = 250_000):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        whole = Tokenizer.from_file(file)
        self.encode, self.model = whole.encode, whole.model.tokenize
        self.signs = _byte_signs()
        self.old: dict[bytes, bytes] = {}
        self.most = most

    def __missing__(self, run: bytes) -> bytes:
        ids = self.old.get(run)
        if ids is None:
            text = run.decode()
            if text.isalpha() and max(text) < "\u0180" and "\u0130" not in text:
                low = text.lower()
                if low != text:
                    ids = self[low.encode()]
                else:
                    shown = text if text.isascii() else run.decode("latin-1").translate(self.signs)
                    ids = array("I", [t.id for t in self.model(shown)]).tobytes()
            elif (word := text.rstrip(MARKS)) != text and word.isalpha() and word[-1] < "\u0180" and word[-1] != "\u0130":
                ids = self[word.encode()] + self[text[len(word):].encode()]
            else:
                ids = array("I", self.encode(text, add_special_tokens=False).ids).tobytes()
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[run] = ids
        return ids


_CACHES: dict[str, ChunkIds] = {}


def _pieces(file: str, size: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _CACHES.setdefault(file, ChunkIds(file))  # a worker keeps it for its next task
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, t in enumerate(batch.column(1)):
                data = b"".join(map(ids_of.__getitem__, (t.as_py() or "").encode().split())) + end
                for k in range(0, len(data), 4 * size):
                    part = data[k:k + 4 * size]
                    row.append(i)
                    piece.append(k // (4 * size))
                    start.append(k // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            out = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                out.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names=names)
    return run


def best_fit(counts: dict[int, int], cap: Capacity, rule: str = "norm", weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)) -> np.ndarray:
    """Slots for ``counts`` pieces of each length: rows (length, first rank,
    sequences, copies in each, first sequence, offset) in order of length and
    rank. ``weights`` are of tokens, documents and cost, each as a share of
    its capacity."""
    full = np.array([cap.tokens, cap.docs, cap.cost], float)
    w = np.asarray(weights, float)
    size = 1024
    left, bins = np.zeros((size, 3), np.int64), np.zeros(size, np.int64)  # residuals and number of equal sequences
    filled: list[list[tuple[int, int]]] = []
    closed: list[tuple[int, list[tuple[int, int]]]] = []

    def put(n: int, residual: np.ndarray, content: list[tuple[int, int]]) -> None:
        nonlocal left, bins
        if residual[0] < 1 or residual[1] < 1 or residual[2] < 1:
            closed.append((n, content))
            return
        if len(filled) == len(bins):
            left, bins = np.vstack([left, np.zeros_like(left)]), np.concatenate([bins, np.zeros_like(bins)])
        left[len(filled)], bins[len(filled)] = residual, n
        filled.append(content)

    for length in sorted(counts, reverse=True):
        c = counts[length]
        need = np.array([length, 1, length * length], np.int64)
        while c:
            g = len(filled)
            ok = np.flatnonzero((left[:g] >= need).all(axis=1) & (bins[:g] > 0))
            if not len(ok):
                most = int((full.astype(np.int64) // need).min())
                for n, k in ((c // most, most), (1, c % most)):
                    if n and k:
                        put(n, full.astype(np.int64) - k * need, [(length, k)])
                break
            rest = left[ok] / full
            if rule == "norm":
                best = ok[np.argmin((w * (rest - need / full) ** 2).sum(axis=1))]
            else:
                best = ok[np.argmax((w * rest * (need / full)).sum(axis=1) / np.sqrt((w * rest * rest).sum(axis=1)))]
            k = min(int((left[best] // need).min()), c)
            n = min(int(bins[best]), c // k)
            put(n, left[best] - k * need, [*filled[best], (length, k)])
            bins[best] -= n
            if not bins[best]:
                filled[best] = []
            c -= n * k
    used = closed + [(int(bins[i]), filled[i]) for i in range(len(filled)) if bins[i]]
    rank, first, slots = dict.fromkeys(counts, 0), 0, []
    for n, content in used:
        offset = 0
        for length, k in content:
            slots.append((length, rank[length], n, k, first, offset))
            rank[length] += n * k
            offset += k * length
        first += n
    return np.array(sorted(slots), np.int64).reshape(-1, 6)


def _place(slots: np.ndarray, size: int, keep: list[str]):
    """Sequence and offset of each row from its length and rank."""
    span = 1 << 48  # above any rank
    key = slots[:, 0] * span + slots[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("length", "rank"))
            at = slots[np.searchsorted(key, length * span + rank, side="right") - 1]
            nth = rank - at[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in keep), pa.array(at[:, 4] + nth // at[:, 3]), pa.array(at[:, 5] + nth % at[:, 3] * length)],
                names=[*keep, "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, cap: Capacity = Capacity(), rule: str = "norm", with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text",
         vocabulary: str = "word_bpe_49k.json", folder: str | None = None, end_id: int = 1) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32[, ids], sequence_id,
    offset), one for each piece of each row of ``docs``.

    A null or empty text is the end id alone. Rows that repeat an id are packed
    each for itself; a null id stays null. Equal lengths are ranked by id, piece
    and checksum. Other columns of ``docs`` are not read. An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # rows that repeat are interchangeable: a counter deals them, written so that it stays as it is
    cut = rows.mapInArrow(_pieces(tokenizer_file(vocabulary, folder), cap.piece, end_id, with_ids), schema)
    pieces = shared_table(spark, cut.withColumn("spread", F.monotonically_increasing_id()), "pieces")
    columns = [c for c in pieces.columns if c != "spread"]
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most cap.piece rows
    slots = best_fit(counts, cap, rule)
    buckets = math.ceil(math.sqrt(sum(counts.values())) / 16) or 1
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "spread"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("length", "bucket").count().select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32", "spread")
    ranked = (dealt.withColumn("nth", F.row_number().over(within) - 1).join(offsets, ["length", "bucket"])
              .withColumn("rank", F.col("before") + F.col("nth")).select(*columns, "rank"))
    return ranked.mapInArrow(_place(slots, cap.piece, columns), schema + ", sequence_id long, offset long")


@register("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
