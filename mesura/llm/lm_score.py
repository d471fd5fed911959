"""Language-model scores by a weighted backoff automaton.

The model is an n-gram model with Dirichlet smoothing: the probability of a
word w after a context h is (c(hw) + k * P(w | h')) / (c(h) + k), where h' is h
without its first word; the empty context has P(w) = (c(w) + a) /
(N + a * (V + 1)), an unseen word included. As an automaton: every n-gram
shorter than the order that was seen is a state, an n-gram hw seen is an arc
from h with the weight above to the longest suffix of hw that is a state, and
a state's failure arc leads to h' with the weight k / (c(h) + k). A text is
read once from left to right: a word without an arc from the state follows
failure arcs, their weights and the arc's are added, and the state moves on.

Scale. The n-grams grow with the corpus, so no task holds them all and none
are broadcast. Texts are gathered in batches of a bounded number of tokens,
each a row that holds word numbers. A batch asks for its own distinct n-grams,
with its training counts, and the askers' lists are cut by ranges of hashes:
one shuffle, in which a common word is one entry a batch and not one a token.
Each range sums the counts and answers every batch in the order it asked. A
batch then builds the part of the automaton that its texts can reach, which is
all they need, and traverses it in lanes side by side. A text longer than a
batch is cut into parts that begin with the words before them, so a part's
first state is that of the whole text; sums of parts are added by row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mesura.llm.common import doc_split, mix64, read_table, register, shared_table
from mesura.llm.near_dedup import word_hashes


@dataclass(frozen=True)
class Params:
    """``order`` is the longest n-gram. ``strength`` is k, ``add`` is a.
    ``batch`` bounds the tokens of a batch, ``answer`` the n-grams of a range
    of hashes on average, ``lane`` the tokens that a lane reads."""

    order: int = 2
    strength: float = 16.0
    add: float = 0.1
    batch: int = 1_000_000
    answer: int = 2_000_000
    lane: int = 512


END = int(mix64(np.array([0x656E64], np.uint64))[0])  # stands for the end of a text
BEGIN = int(mix64(np.array([0x626567], np.uint64))[0])  # the context of a text's first word
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _planes(x: np.ndarray) -> bytes:
    """Integers by bytes of one weight, packed: small ones cost little."""
    raw = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw).tobytes())


def _unplanes(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def _ascending(x: np.ndarray) -> bytes:
    return _planes(np.diff(x, prepend=np.uint64(0)))


def _unascending(data: bytes) -> np.ndarray:
    return np.cumsum(_unplanes(data, np.uint64), dtype=np.uint64)


BATCH = "batch long, tokens long, train_tokens long, train_texts long, words binary, stream binary, parts binary, rows binary, ids binary"


class _Gather:
    """Collects parts of texts and gives batches of them."""

    def __init__(self, p: Params, first: int):
        self.p, self.next, self.count = p, first, first
        self.clear()

    def clear(self) -> None:
        self.streams: list[np.ndarray] = []
        self.parts: list[tuple[int, int, int]] = []  # words of context, own tokens, training or not
        self.rows: list[int] = []
        self.ids: list[tuple[int, int]] = []  # (id, 0: null, 1: known)
        self.held = 0

    def add(self, text: str | None, doc: int | None, train: bool) -> Iterator[dict]:
        row, self.count = self.count, self.count + 1
        tokens = np.append(word_hashes((text or "").encode()), np.uint64(END))
        at = 0
        while at < len(tokens):
            own = min(len(tokens) - at, self.p.batch - self.held)
            before = tokens[max(0, at - self.p.order + 1):at] if self.p.order > 1 else tokens[:0]
            if len(before) < self.p.order - 1:
                before = np.concatenate([np.array([BEGIN], np.uint64), before])
            self.streams += [before, tokens[at:at + own]]
            self.parts.append((len(before), own, 2 * train + (at == 0)))
            self.rows.append(row)
            self.ids.append((doc or 0, doc is not None))
            self.held += own
            at += own
            if self.held >= self.p.batch:
                yield self.give()

    def give(self) -> dict:
        words, stream = np.unique(np.concatenate(self.streams), return_inverse=True)
        parts = np.array(self.parts, np.int64)
        train = parts[:, 2] >= 2
        out = {"batch": self.next, "tokens": int(parts[:, 1].sum()), "train_tokens": int(parts[train, 1].sum()), "train_texts": int((parts[:, 2] == 3).sum()),
               "words": _ascending(words), "stream": _planes(stream.astype(np.uint32)), "parts": _planes(parts), "rows": _planes(np.array(self.rows, np.int64)),
               "ids": _planes(np.array(self.ids, np.int64))}
        self.next += 1
        self.clear()
        return out


def _batches(p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a task's own range of numbers for its rows and batches
        gather = _Gather(p, TaskContext.get().partitionId() << 40)
        give = lambda x: pa.RecordBatch.from_pylist([x], _SCHEMA)
        for batch in batches:
            for doc, text, train in zip(*(batch.column(k) for k in range(3))):
                for full in gather.add(text.as_py(), doc.as_py(), train.as_py()):
                    yield give(full)
        if gather.parts:
            yield give(gather.give())
    return run


_SCHEMA = pa.schema([(f.split()[0], pa.int64() if f.endswith("long") else pa.binary()) for f in BATCH.split(", ")])


@dataclass
class Grams:
    """The n-grams of a batch. ``ids[k]`` numbers the (k+1)-gram that ends at
    each place of the stream (-1: none), ``keys[k]`` is the hash of each,
    ``prefix[k]`` and ``last[k]`` the number of its context (a k-gram) and of
    its last word, ``suffix[k]`` that of the k-gram without its first word."""

    own: np.ndarray
    train: np.ndarray
    part: np.ndarray
    parts: np.ndarray
    ids: list[np.ndarray]
    keys: list[np.ndarray]
    prefix: list[np.ndarray]
    last: list[np.ndarray]
    suffix: list[np.ndarray]
    begin: int

    @classmethod
    def of(cls, row: dict, order: int) -> "Grams":
        words, parts = _unascending(row["words"]), _unplanes(row["parts"], np.int64).reshape(-1, 3)
        stream = _unplanes(row["stream"], np.uint32).astype(np.int64)
        size = parts[:, 0] + parts[:, 1]
        part = np.repeat(np.arange(len(parts)), size)
        place = np.arange(len(stream)) - np.repeat(np.cumsum(size) - size, size)
        own = place >= parts[part, 0]
        at = np.searchsorted(words, np.uint64(BEGIN))
        begin = int(at) if at < len(words) and words[at] == np.uint64(BEGIN) else -1
        ids, keys = [stream], [words & ~np.uint64(1)]
        prefix, last, suffix = [np.full(len(words), -1)], [np.arange(len(words))], [np.full(len(words), -1)]
        for k in range(1, order):
            fits = np.flatnonzero((place >= k) & (ids[-1] >= 0))
            fits = fits[ids[-1][fits - 1] >= 0]
            pair = ids[-1][fits - 1] * len(words) + stream[fits]
            pairs, first, back = np.unique(pair, return_index=True, return_inverse=True)
            now = np.full(len(stream), -1, np.int64)
            now[fits] = back
            prefix.append(pairs // len(words))
            last.append(pairs % len(words))
            suffix.append(ids[-1][fits[first]])
            keys.append(mix64(keys[-1][prefix[-1]] * _ODD + keys[0][last[-1]]) | np.uint64(1))
            ids.append(now)
        return cls(own, parts[part, 2] >= 2, part, parts, ids, keys, prefix, last, suffix, begin)

    def asked(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hashes in order, and for each n-gram of ``keys``, one
        order after the other, the place of its hash."""
        return np.unique(np.concatenate(self.keys), return_inverse=True)

    def trained(self) -> np.ndarray:
        """Training occurrences of each n-gram, in the order of ``asked``'s places."""
        at = self.own & self.train
        return np.concatenate([np.bincount(i[at & (i >= 0)], minlength=len(k)) for i, k in zip(self.ids, self.keys)])


def _ask(p: Params, bits: int):
    """One row for each range of hashes that a batch asks of."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                grams = Grams.of(row, p.order)
                keys, back = grams.asked()
                counts = np.zeros(len(keys), np.uint32)
                np.add.at(counts, back, grams.trained().astype(np.uint32))
                cuts = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else []
                parts = [(r, x, c) for r, (x, c) in enumerate(zip(np.split(keys, cuts), np.split(counts, cuts))) if len(x)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r for r, _, _ in parts], pa.int32()), pa.array([row["batch"]] * len(parts), pa.int64()),
                     pa.array([_ascending(x) for _, x, _ in parts], pa.binary()), pa.array([_planes(c) for _, _, c in parts], pa.binary())],
                    names=["range", "batch", "keys", "counts"])
    return run


def _answer(asked: pa.Table) -> pa.Table:
    """Counts of all batches for each batch's n-grams, in its order, and in a
    row of their own (a null batch) the number of distinct training words."""
    keys = [_unascending(x.as_py()) for x in asked["keys"]]
    counts = [_unplanes(x.as_py(), np.uint32) for x in asked["counts"]]
    size = np.cumsum([len(k) for k in keys])[:-1]
    known, back = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(known), np.int64)
    np.add.at(total, back, np.concatenate(counts).astype(np.int64))
    words = int(((known & np.uint64(1)) == 0)[total > 0].sum())
    ranges = asked["range"].to_pylist()
    return pa.table([pa.array([*ranges, ranges[0]], pa.int32()), pa.array([*asked["batch"].to_pylist(), None], pa.int64()),
                     pa.array([*(_planes(x) for x in np.split(total[back], size)), None], pa.binary()), pa.array([None] * len(ranges) + [words], pa.int64())],
                    names=["range", "batch", "counts", "words"])


@dataclass(frozen=True)
class Totals:
    """Training tokens, distinct training words, training texts."""

    tokens: int
    words: int
    texts: int


class Automaton:
    """States, arcs and failure arcs that a batch's texts can reach.

    State 0 is the empty context; the others are contexts that were seen. An
    arc's key is its state times the number of words plus its word."""

    def __init__(self, grams: Grams, counts: list[np.ndarray], totals: Totals, p: Params):
        self.words = len(grams.keys[0])
        base = np.log10((counts[0] + p.add) / (totals.tokens + p.add * (totals.words + 1)))
        self.base = base
        if grams.begin >= 0:  # it begins every training text
            counts = [counts[0].copy(), *counts[1:]]
            counts[0][grams.begin] = totals.texts
        self.fail, self.fall = [np.zeros(1, np.int64)], [np.zeros(1)]
        state: list[np.ndarray] = []  # of each n-gram: its own, or that of its longest suffix
        number = 1
        for k in range(p.order - 1):
            seen = np.flatnonzero(counts[k] > 0)
            suffix = state[-1][grams.suffix[k]] if k else np.zeros(len(counts[0]), np.int64)
            own = suffix.copy()
            own[seen] = number + np.arange(len(seen))
            self.fail.append(suffix[seen])
            self.fall.append(np.log10(p.strength / (counts[k][seen] + p.strength)))
            state.append(own)
            number += len(seen)
        self.fail, self.fall = np.concatenate(self.fail), np.concatenate(self.fall)
        keys, weights, goals = [], [], []
        chance: list[np.ndarray] = [10.0 ** base]
        for k in range(p.order):
            if k:
                # the probability after the shorter context is that of the n-gram without its first word
                after = counts[k - 1][grams.prefix[k]]
                chance.append((counts[k] + p.strength * chance[k - 1][grams.suffix[k]]) / (after + p.strength))
                arcs = np.flatnonzero((counts[k] > 0) & (after > 0))
                keys.append(state[k - 1][grams.prefix[k][arcs]] * self.words + grams.last[k][arcs])
            else:
                arcs = np.arange(self.words)  # from the empty context every word has an arc
                keys.append(arcs)
            weights.append(np.log10(chance[k][arcs]))
            to = state[k] if k < p.order - 1 else state[k - 1][grams.suffix[k]] if k else np.zeros(self.words, np.int64)
            goals.append(to[arcs])
        order = np.argsort(np.concatenate(keys), kind="stable")
        self.keys, self.weights, self.goals = (np.concatenate(x)[order] for x in (keys, weights, goals))

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States after one word each, and the log-probabilities of the words."""
        state, score, goal = state.copy(), np.zeros(len(state)), np.zeros(len(state), np.int64)
        left = np.arange(len(state))
        while len(left):
            key = state[left] * self.words + word[left]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            done, arc = left[hit], at[hit]
            score[done] += self.weights[arc]
            goal[done] = self.goals[arc]
            left = left[~hit]
            score[left] += self.fall[state[left]]
            state[left] = self.fail[state[left]]
        return goal, score

    def read(self, stream: np.ndarray, start: np.ndarray, silent: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Log-probabilities of lanes: each reads the stream from ``start`` to
        ``end``; the first ``silent`` words only lead to its first state."""
        order = np.argsort(start - end, kind="stable")  # the longest first
        start, silent, length = start[order], silent[order], (end - start)[order]
        state, total = np.zeros(len(start), np.int64), np.zeros(len(start))
        for t in range(int(length.max(initial=0))):
            n = int(np.searchsorted(-length, -t, side="left"))  # lanes longer than t
            state[:n], score = self.step(state[:n], stream[start[:n] + t])
            total[:n] += np.where(silent[:n] <= t, score, 0.0)
        out = np.empty(len(total))
        out[order] = total
        return out


def lanes(grams: Grams, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(part, start, silent words, end) of the lanes of all parts."""
    size = grams.parts[:, 0] + grams.parts[:, 1]
    first = np.cumsum(size) - size + grams.parts[:, 0]
    many = -(-grams.parts[:, 1] // p.lane)
    part = np.repeat(np.arange(len(many)), many)
    nth = np.arange(len(part)) - np.repeat(np.cumsum(many) - many, many)
    begin = first[part] + nth * p.lane
    end = np.minimum(begin + p.lane, first[part] + grams.parts[part, 1])
    silent = np.minimum(p.order - 1, np.where(nth == 0, grams.parts[part, 0], nth * p.lane + grams.parts[part, 0]))
    return part, begin - silent, silent, end


SCORED = "row long, doc_id long, n_tokens long, n_known long, base_score double, score double"


def _score(p: Params, totals: Totals):
    def run(batch: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for row in batch.to_pylist():  # one
            grams = Grams.of(row, p.order)
            keys, back = grams.asked()
            told = answers.sort_by("range")
            count = np.concatenate([_unplanes(x.as_py(), np.int64) for x in told["counts"]])[back]
            counts = np.split(count, np.cumsum([len(k) for k in grams.keys])[:-1])
            machine = Automaton(grams, counts, totals, p)
            part, start, silent, end = lanes(grams, p)
            score = np.bincount(part, weights=machine.read(grams.ids[0], start, silent, end), minlength=len(grams.parts))
            own = np.flatnonzero(grams.own)
            word, of = grams.ids[0][own], grams.part[own]
            known = np.bincount(of, weights=counts[0][word] > 0, minlength=len(grams.parts)).astype(np.int64)
            base = np.bincount(of, weights=machine.base[word], minlength=len(grams.parts))
            ids = _unplanes(row["ids"], np.int64).reshape(-1, 2)
            out.append(pa.table([pa.array(_unplanes(row["rows"], np.int64)), pa.array(ids[:, 0], mask=ids[:, 1] == 0), pa.array(grams.parts[:, 1]),
                                 pa.array(known), pa.array(base), pa.array(score)], names=[f.split()[0] for f in SCORED.split(", ")]))
        return pa.concat_tables(out) if out else pa.table({f.split()[0]: pa.array([], pa.float64() if f.endswith("double") else pa.int64()) for f in SCORED.split(", ")})
    return run


def lm_scores(docs: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score), one for each row of ``docs``; logarithms to base 10.

    Tokens are the words between ASCII white space with A-Z lower-cased, then
    one end. A null or empty text is its end alone. The model learns from rows
    whose crc32 of the id as text is not divisible by 10; the others are held
    out. A null id is neither held out nor learned from. Rows that repeat an id
    or a text count, and are returned, each for itself. Very long texts are
    read whole, in parts. Without training rows every token has the same
    probability, 1. An empty table gives an empty result; other columns are
    not read.
    """
    spark = docs.sparkSession
    train = F.coalesce(doc_split(id_col, 10) != 0, F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), train.alias("train"))
    batches = shared_table(spark, rows.mapInArrow(_batches(p), BATCH), "lm-batches")
    found = batches.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "train_tokens", "train_texts"))).first()
    bits = max(0, math.ceil(math.log2(max(1, p.order * found[0] / p.answer))))
    asked = batches.mapInArrow(_ask(p, bits), "range int, batch long, keys binary, counts binary")
    answers = shared_table(spark, asked.groupBy("range").applyInArrow(_answer, "range int, batch long, counts binary, words long"), "lm-answers")
    words = answers.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    totals = Totals(found[1], words, found[2])
    told = answers.filter("batch is not null").select(F.col("range"), F.col("batch").alias("of"), "counts")
    parts = batches.groupBy("batch").cogroup(told.groupBy("of")).applyInArrow(_score(p, totals), SCORED)
    sums = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    scored = parts.groupBy("row").agg(F.max("doc_id").alias("doc_id"), *sums)
    return scored.select("doc_id", F.coalesce(doc_split("doc_id", 10) == 0, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
                         F.lit(totals.tokens).cast("long").alias("train_tokens"), "base_score", "score")


@register("op13_lm_scoring")
def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read_table(spark, sf_dir, "documents"))
