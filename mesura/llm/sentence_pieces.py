"""SentencePiece encoding by sampled segmentation, and lossless decoding.

A text's segmentations are the paths of its piece lattice; a path's weight is
the product of its pieces' probabilities, raised to ``alpha``. Forward sums
over the lattice and backward sampling draw a path exactly from that
distribution. The draws come from a counter-based generator keyed by the row's
key, so a row's segmentation is the same in every run, wherever it is computed.

A word is a run of spaces with what stands behind it up to the next space. No
piece of the vocabulary goes from a sign to a space behind it or over a line
end, so the lattice is a chain of the lattices of the words, however long they
are (text without spaces is one word). Forward sums are
computed once for each distinct word of a batch, over all words at once; the
backward draws go over all words of a batch at once too, one piece a step.
Nothing is shuffled; memory is bounded by a slice of a batch, and by its
longest text: a lattice takes some 200 bytes a sign.

Encoding is without normalisation: a space is the mark U+2581, and whatever
the vocabulary has no piece for, U+2581 itself included, goes to byte pieces,
so decoding gives back every text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mesura.llm.common import mix64, read_table, register, tokenizer_file

SPACE = "▁"
_WORD = re.compile(" *[^ \n▁]+| +|[\n▁]")


@dataclass(frozen=True)
class Params:
    """``alpha`` sharpens (above 1) or flattens the distribution; ``seed``
    keys the draws beside the row's key. The vocabulary's pieces are ranked,
    not weighted; a piece of rank r gets log-probability -log(r + ``shift``).
    ``most`` is the number of words handled at once."""

    vocabulary: str = "piece_bpe_32k.model"
    folder: str | None = None
    alpha: float = 1.0
    shift: float = 100.0
    seed: int = 0
    most: int = 400_000


_BASE = np.uint64(0x9E3779B97F4A7C15)


_MASK = (1 << 20) - 1
_WHOLE = (1 << 64) - 1


def _tables(keys: np.ndarray, ids: np.ndarray) -> list[tuple[np.uint64, np.ndarray, np.ndarray]]:
    """Hash tables one behind the other: (shift, keys, ids), each by other
    bits of the hash; what meets a taken slot goes to the next. -3 marks a
    free slot."""
    out = []
    while len(keys):
        shift = np.uint64((44 - 11 * len(out)) % 45)
        at = (keys >> shift).astype(np.int64) & _MASK
        _, first = np.unique(at, return_index=True)
        own, value = np.zeros(_MASK + 1, np.uint64), np.full(_MASK + 1, -3, np.int64)
        own[at[first]], value[at[first]] = keys[first], ids[first]
        out.append((shift, own, value))
        left = np.ones(len(keys), bool)
        left[first] = False
        keys, ids = keys[left], ids[left]
    return out


class Pieces:
    """The vocabulary's pieces by a hash of their code points."""

    def __init__(self, file: str, p: Params):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=file)
        size = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(size)]
        self.byte = np.full(256, -1, np.int64)
        self.said = [s.replace(SPACE, " ").encode() for s in self.text]  # by a piece in a decoded text
        keep: list[int] = []
        for i, s in enumerate(self.text):
            if sp.is_byte(i):
                self.byte[int(s[3:5], 16)], self.said[i] = i, bytes([int(s[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) and s and "\n" not in s:
                if SPACE in s.lstrip(SPACE):
                    raise ValueError(f"piece {s!r} goes from a sign to a space: words are no chain")
                keep.append(i)
        order = sorted(keep, key=lambda i: (-sp.get_score(i), i))
        logp = np.full(size, np.nan)
        logp[order] = -p.alpha * np.log(np.arange(len(order)) + p.shift)
        self.unknown = float(-p.alpha * (np.log(len(order) + p.shift) + 2.0))  # of a byte
        self.longest = max(len(self.text[i]) for i in keep)
        # every ending of a piece, with the piece it is, if it is one
        known: dict[int, int] = {}
        for i in keep:
            h, power = 0, 1
            for c in reversed(self.text[i]):
                h = (h + self.sign(c) * power) & _WHOLE
                power = power * int(_BASE) & _WHOLE
                known.setdefault(h, -1)
            known[h] = i
        self.tables = _tables(np.fromiter(known, np.uint64, len(known)), np.fromiter(known.values(), np.int64, len(known)))
        self.logp = logp

    @staticmethod
    @cache
    def sign(c: str) -> int:
        return int(mix64(np.array([ord(c) + 1], np.uint64))[0])

    def find(self, h: np.ndarray) -> np.ndarray:
        """For each hash the piece's id, -1 for an ending of a piece only, -2
        for neither."""
        out = np.full(len(h), -2, np.int64)
        rest = np.arange(len(h))
        for shift, keys, ids in self.tables:
            at = (h[rest] >> shift).astype(np.int64) & _MASK
            hit = keys[at] == h[rest]
            out[rest[hit]] = ids[at[hit]]
            rest = rest[~hit & (ids[at] != -3)]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of piece ids."""
        return b"".join(map(self.said.__getitem__, ids.tolist())).decode()


def words_of(text: str) -> list[str]:
    """A text cut where no piece crosses: before each run of spaces, and
    around a line end or a mark."""
    return _WORD.findall(text)


class Lattices:
    """Lattices of distinct words with, for each end position, its incoming
    pieces and the cumulative probabilities of the backward draw."""

    def __init__(self, words: list[str], pieces: Pieces):
        joined = "".join(words)
        code = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
        length = np.array([len(w) for w in words], np.int64)
        self.length = length
        start = np.concatenate([[0], np.cumsum(length)])[:-1]
        self.node = start + np.arange(len(words))  # first node of each word; a word of n signs has n + 1
        nodes = int(length.sum()) + len(words)
        code = np.where(code == 32, ord(SPACE), np.where(code == ord(SPACE), 0x110000, code))  # the mark itself has no piece
        sign = mix64(code.astype(np.uint64) + np.uint64(1))
        # place of each code point in its word, and edges (end node, begin node, piece)
        word = np.repeat(np.arange(len(words)), length)
        place = np.arange(len(code)) - start[word]
        end_node = self.node[word] + place + 1
        found_at: list[tuple[np.ndarray, int, np.ndarray, np.ndarray]] = []  # end, signs, piece, log-probability
        h = np.zeros(len(code), np.uint64)
        power = np.uint64(1)
        ok = np.arange(len(code))
        with np.errstate(over="ignore"):
            n = 1
            while len(ok):
                # hash of the n signs that end here, grown to the left while a piece ends so
                h[ok] += sign[ok - (n - 1)] * power
                power = power * _BASE
                found = pieces.find(h[ok])
                if n == 1:
                    bare = ok[found < 0]
                    size = np.where(code[bare] < 0x80, 1, np.where(code[bare] < 0x800, 2, np.where(code[bare] < 0x10000, 3, np.where(code[bare] == 0x110000, 3, 4))))
                    found_at.append((end_node[bare], 1, np.full(len(bare), -1), size * pieces.unknown))
                hit = found >= 0
                found_at.append((end_node[ok[hit]], n, found[hit], pieces.logp[found[hit]]))
                ok = ok[found > -2]
                ok = ok[place[ok] >= n]
                n += 1
        # edges in order of their end node; an end has one edge of a length at most
        count = np.zeros(nodes + 1, np.int64)
        for end, _, _, _ in found_at:
            count[end + 1] += 1
        self.first = np.cumsum(count)
        edges, cursor = int(self.first[-1]), self.first[:-1].copy()
        end, begin, piece, cost = np.zeros(edges, np.int64), np.zeros(edges, np.int64), np.zeros(edges, np.int64), np.zeros(edges)
        for e, n, x, c in found_at:
            at = cursor[e]
            end[at], begin[at], piece[at], cost[at] = e, e - n, x, c
            cursor[e] += 1
        # forward sums, all words at once, place by place
        alpha = np.full(nodes, -np.inf)
        alpha[self.node] = 0.0
        at_place = np.zeros(nodes, np.int32)
        at_place[end_node] = place + 1
        edge_place = at_place[end]
        by_place = np.argsort(edge_place, kind="stable")
        bounds = np.searchsorted(edge_place[by_place], np.arange(1, int(length.max(initial=0)) + 2))
        reach = np.zeros(edges)
        for k in range(len(bounds) - 1):
            e = by_place[bounds[k]:bounds[k + 1]]
            if not len(e):
                continue
            x = alpha[begin[e]] + cost[e]
            own = end[e]
            head = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            top = np.maximum.reduceat(x, head)
            total = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, np.diff(np.append(head, len(e))))), head))
            alpha[own[head]] = total
            reach[e] = x
        share = np.exp(reach - alpha[end])
        # cumulative shares of a node's edges
        upto = np.cumsum(share)
        upto -= np.concatenate([[0.0], upto])[self.first[end]]
        upto[self.first[1:][np.diff(self.first) > 0] - 1] = 2.0  # the last takes what rounding leaves
        self.begin, self.piece, self.upto = begin, piece, upto

    def sample(self, word: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sampled edges of word occurrences (number of the distinct word, key
        of the draws): (occurrence, edge), pieces of an occurrence in order."""
        at = self.node[word] + self.length[word]
        who, step, out_who, out_edge = np.arange(len(word)), 0, [], []
        while len(who):
            u = (mix64(key[who] + np.uint64(((step + 1) * int(_BASE)) & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(11)).astype(float) * 2.0 ** -53
            edge = self.first[at]
            far = np.flatnonzero(self.upto[edge] <= u)
            while len(far):
                edge[far] += 1
                far = far[self.upto[edge[far]] <= u[far]]
            out_who.append(who)
            out_edge.append(edge)
            at = self.begin[edge]
            on = at > self.node[word[who]]
            who, at, step = who[on], at[on], step + 1
        if not out_who:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        w, e = np.concatenate(out_who)[::-1], np.concatenate(out_edge)[::-1]  # draws run from the end of a word
        order = np.argsort(w, kind="stable")
        return w[order], e[order]


class _Numbers(dict):
    """Numbers words in order of their first use."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


class Sampler:
    """Sampled encodings of many texts."""

    def __init__(self, pieces: Pieces, p: Params):
        self.pieces, self.p = pieces, p

    def encode(self, texts: list[str], keys: np.ndarray) -> list[np.ndarray]:
        """Piece ids of each text; ``keys`` are the rows' keys (uint64)."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        todo: list[tuple[int, int, list[str]]] = []
        held = 0
        for i, t in enumerate(texts):
            words = words_of(t)
            for k in range(0, len(words), self.p.most):  # a long text goes in parts
                part = words[k:k + self.p.most]
                if held + len(part) > self.p.most and todo:
                    self._draw(todo, keys, out)
                    todo, held = [], 0
                todo.append((i, k, part))
                held += len(part)
        if todo:
            self._draw(todo, keys, out)
        return [np.concatenate(x) if x else np.zeros(0, np.int32) for x in out]

    def _draw(self, todo: list[tuple[int, int, list[str]]], keys: np.ndarray, out: list[list[np.ndarray]]) -> None:
        number = _Numbers()
        ids = np.fromiter(chain.from_iterable(map(number.__getitem__, part) for _, _, part in todo), np.int64)
        distinct = list(number)
        lattices = Lattices(distinct, self.pieces)
        counts = np.array([len(part) for _, _, part in todo])
        seed = mix64(np.array([self.p.seed], np.uint64) + _BASE)[0]
        row = np.repeat(np.array([keys[i] for i, _, _ in todo], np.uint64), counts)
        nth = np.concatenate([np.arange(k, k + len(part), dtype=np.uint64) for _, k, part in todo])
        who, edge = lattices.sample(ids, mix64(mix64(row ^ seed) + nth * np.uint64(0xD1B54A32D192ED03)))
        piece = lattices.piece[edge]
        size = np.ones(len(piece), np.int64)
        bare = np.flatnonzero(piece < 0)
        if len(bare):  # signs without a piece: their bytes
            start = np.concatenate([[0], np.cumsum(lattices.length)])
            signs = "".join(distinct)
            place = lattices.begin[edge[bare]] - lattices.node[ids[who[bare]]] + start[ids[who[bare]]]
            said = [self.pieces.byte[np.frombuffer(signs[k].encode(), np.uint8)] for k in place.tolist()]
            size[bare] = [len(b) for b in said]
            full = np.repeat(piece, size)
            at = np.cumsum(size) - size
            many = np.concatenate(said)
            lengths = size[bare]
            full[np.repeat(at[bare] - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(many))] = many
            piece = full
        ends = np.cumsum(np.bincount(who, weights=size, minlength=len(ids)).astype(np.int64)) if len(who) else np.zeros(len(ids), np.int64)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        for (i, _, _), a, b in zip(todo, bounds[:-1], bounds[1:]):
            out[i].append(piece[a:b].astype(np.int32))


@cache
def sampler(file: str, p: Params) -> Sampler:
    """A worker keeps it for its next tasks."""
    return Sampler(Pieces(file, p), p)


def _encode(p: Params, file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sampler(file, p)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [x.as_py() for x in part.column(1)]
                keys = part.column(0).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                ids = iter(own.encode([t for t in texts if t is not None], keys[[t is not None for t in texts]]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([None if t is None else next(ids) for t in texts], pa.list_(pa.int32()))], names=["doc_id", "pieces"])
    return run


def encode(docs: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, pieces), one for each row of ``docs``.

    A null text has null pieces, an empty one none. Rows that repeat an id and
    text are encoded alike; a null id has the key -1. Other columns are not
    read. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_encode(p, tokenizer_file(p.vocabulary, p.folder)), "doc_id long, pieces array<int>")


def _decode(p: Params, file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = sampler(file, p).pieces
        for batch in batches:
            n, crc, text = [], [], []
            for x in batch.column(1):
                ids = None if not x.is_valid else x.values.to_numpy(zero_copy_only=False)
                n.append(None if ids is None else len(ids))
                crc.append(None if ids is None else zlib.crc32(ids.astype("<u4").tobytes()))
                text.append(None if ids is None else pieces.decode(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(text, pa.string())], names=["doc_id", "n_pieces", "pieces_crc32", "text"])
    return run


def decode(encoded: DataFrame, p: Params = Params()) -> DataFrame:
    """Rows (doc_id, n_pieces, pieces_crc32, text) of ``encode``'s rows; null
    pieces give nulls."""
    return encoded.select("doc_id", "pieces").mapInArrow(_decode(p, tokenizer_file(p.vocabulary, p.folder)), "doc_id long, n_pieces long, pieces_crc32 long, text string")


@register("op3_sentencepiece_sampling")
def op3_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each document: pieces of its sampled segmentation, their checksum,
    and length and checksum of the text decoded from them."""
    decoded = decode(encode(read_table(spark, sf_dir, "documents")))
    text = F.col("text")
    return decoded.select("doc_id", "n_pieces", "pieces_crc32", F.length(text).cast("long").alias("n_chars"), F.crc32(text.cast("binary")).alias("text_crc32"))
