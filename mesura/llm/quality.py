"""Quality rules with tokeniser fertility.

Word rules come first: too few words or too many repeated three-word windows
fail. For the rest a public vocabulary tells how far a text is from the
language it is written in: characters per token fall for noise, codes and
foreign scripts, byte-fallback tokens stand for characters the vocabulary does
not know, and the entropy of the tokens falls for repetition. Each language
(the script, where none is given) has its own band for each measure: Tukey's
far fences around its quartiles, from exact histograms over all documents that
passed the word rules. A group is only ever judged by its own quartiles; those
of few documents are uncertain, so its fences widen with the square root of
what it lacks. What lies outside a band is rejected.

Scale. One pass measures each text (no shuffle of texts); the measures are
written once. Histograms are summed in each task before the shuffle, and a
language's bands join back as one narrow row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mesura.llm.common import read_table, register, shared_table, tokenizer_file


@dataclass(frozen=True)
class Params:
    """``fence``: quartile distances beyond the quartiles. ``bins``: histogram
    bins a unit. ``least``: documents below which a group's fences widen,
    by the square root of ``least`` over their number. ``slack`` is added to each
    fence (characters a token, byte share, entropy). Entropy is in bits, as a
    share of log2 of the number of tokens or of ``entropy_tokens``, whichever
    is less, so that long texts are not marked down."""

    vocabulary: str = "piece_bpe_32k.model"
    folder: str | None = None
    min_words: int = 50
    repeat_percent: int = 50
    fence: float = 3.0
    bins: int = 200
    least: int = 100
    entropy_tokens: int = 512
    slack: tuple[float, float, float] = (0.1, 0.02, 0.05)


SYMBOLS = "#*$%&|<>"

# Scripts by code point ranges, first that fits.
SCRIPTS = (
    ("Latin", (0x41, 0x24F), (0x1E00, 0x1EFF)), ("Greek", (0x370, 0x3FF)), ("Cyrillic", (0x400, 0x52F)), ("Hebrew", (0x590, 0x5FF)),
    ("Arabic", (0x600, 0x77F)), ("Devanagari", (0x900, 0x97F)), ("Thai", (0xE00, 0xE7F)), ("Kana", (0x3040, 0x30FF)),
    ("Hangul", (0xAC00, 0xD7AF)), ("Han", (0x3400, 0x9FFF)),
)


def script(text: str) -> str:
    """Script of most letters; ``other`` if none is known."""
    c = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    counts = [(sum(int(((c >= a) & (c <= b)).sum()) for a, b in ranges), name) for name, *ranges in SCRIPTS]
    n, name = max(counts, key=lambda x: x[0])
    return name if n else "other"


def word_measures(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode().split()
    # code points: bytes that do not continue one
    chars = sum(map(len, words)) if text.isascii() else sum(len(w.decode()) for w in words)
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    n, repeats = len(words), 0
    if n >= 4:
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
        if len(number) < 1 << 21:
            windows = ids[:-2] << 42 | ids[1:-1] << 21 | ids[2:]
            _, inverse, count = np.unique(windows, return_inverse=True, return_counts=True)
        else:
            _, inverse, count = np.unique(np.stack([ids[:-2], ids[1:-1], ids[2:]], 1), axis=0, return_inverse=True, return_counts=True)
        twice = count[inverse.ravel()] >= 2
        marked = np.zeros(n, bool)
        for k in range(3):
            marked[k:n - 2 + k] |= twice
        repeats = int(marked.sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeats


class Fertility:
    """Measures of a text under a SentencePiece vocabulary."""

    def __init__(self, file: str, entropy_tokens: int):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=file)
        self.is_byte = np.array([self.sp.is_byte(i) or self.sp.is_unknown(i) for i in range(self.sp.get_piece_size())])
        self.most = entropy_tokens

    def measure(self, text: str) -> tuple[int, float, float, float]:
        """Tokens, characters a token, byte-fallback share, entropy share."""
        ids = np.array(self.sp.encode(text), np.int64)
        n = len(ids)
        if n < 2:
            return n, float(len(text)), 0.0, 1.0
        ids.sort()
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        share = np.diff(np.append(first, n)) / n
        entropy = float(-(share * np.log2(share)).sum())
        return n, len(text) / n, float(self.is_byte[ids].mean()), entropy / np.log2(min(n, self.most))


_MEASURES = ("chars_per_token", "byte_share", "entropy_share")
_SCHEMA = ("doc_id long, grp string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "n_tokens long, chars_per_token double, byte_share double, entropy_share double")


def _measured(p: Params, file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fertility = Fertility(file, p.entropy_tokens)
        kinds = [pa.string(), *[pa.int64()] * 6, *[pa.float64()] * 3]
        names = [x.split()[0] for x in _SCHEMA.split(", ")]
        for batch in batches:
            rows = []
            for lang, t in zip(batch.column(1), batch.column(2)):
                text = t.as_py() or ""
                rows.append((lang.as_py() or script(text), *word_measures(text), *fertility.measure(text)))
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=names)
    return run


def fences(measures: DataFrame, p: Params) -> DataFrame:
    """Rows (grp, low_i, high_i for each measure): bands of each group."""
    cells = F.array(*(F.struct(F.lit(i).alias("m"), F.floor(F.col(c) * p.bins).cast("long").alias("bin")) for i, c in enumerate(_MEASURES)))
    counts = measures.select("grp", F.explode(cells).alias("x")).groupBy("grp", "x.m", "x.bin").count()
    up = Window.partitionBy("grp", "m").orderBy("bin")
    counts = counts.withColumn("upto", F.sum("count").over(up)).withColumn("n", F.sum("count").over(Window.partitionBy("grp", "m")))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("n"), F.col("bin"))) / p.bins
    quartiles = counts.groupBy("grp", "m").agg(at(0.25).alias("a"), at(0.75).alias("b"), F.max("n").alias("n"))
    slack = F.element_at(F.array(*map(F.lit, p.slack)), F.col("m") + 1)
    # the error of a quartile goes with 1 / sqrt(n); 1 from ``least`` documents on
    few = F.greatest(F.lit(1.0), F.sqrt(F.lit(float(p.least)) / F.col("n")))
    wide = quartiles.select("grp", "m", (F.col("a") - few * p.fence * (F.col("b") - F.col("a")) - few * slack).alias("low"),
                            (F.col("b") + (F.lit(1.0 / p.bins)) + few * p.fence * (F.col("b") - F.col("a")) + few * slack).alias("high"))
    pick = lambda i, c: F.max(F.when(F.col("m") == i, F.col(c))).alias(f"{c}_{i}")
    return wide.groupBy("grp").agg(*(pick(i, c) for i in range(len(_MEASURES)) for c in ("low", "high")))


def judged(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """Rows (doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, chars_per_token, byte_share,
    entropy_share), one for each row of ``docs``.

    A null or empty text has no words and fails. A null lang counts with its
    script. Characters per token have a low and a high bound, the byte share a
    high one, the entropy share a low one; equal to a bound is kept. Rows that
    repeat an id are judged each for itself. Columns other than doc_id, lang
    and text are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    measures = rows.mapInArrow(_measured(p, tokenizer_file(p.vocabulary, p.folder)), _SCHEMA)
    failed = (F.col("n_words") < p.min_words) | (100 * F.col("n_repeat_words") > p.repeat_percent * F.col("n_words"))
    measures = shared_table(spark, measures.withColumn("base_failed", failed), "measures")
    bands = shared_table(spark, fences(measures.filter("not base_failed"), p), "bands")
    inside = ((F.col("chars_per_token") >= F.col("low_0")) & (F.col("chars_per_token") <= F.col("high_0"))
              & (F.col("byte_share") <= F.col("high_1")) & (F.col("entropy_share") >= F.col("low_2")))
    joined = measures.join(bands, "grp", "left")
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & F.coalesce(inside, F.lit(True))).alias("kept"), *_MEASURES)


@register("op7_quality_rules")
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read_table(spark, sf_dir, "documents"))
