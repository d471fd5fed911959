"""Language identification by rank-order n-gram profiles.

A profile lists the most frequent character n-grams (one to three letters,
word ends included) in order of frequency. A document's own list is compared
with each language's by the out-of-place distance: the sum of the differences
of ranks, the list's length for an n-gram that the language's list has not.
The language with the least distance wins.

Profiles are counted on a bounded sample of labelled rows, summed in each task
before the shuffle; they hold ``Params.length`` n-grams a language. The
distances need no shuffle.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mesura.llm.common import doc_split, read_table, register

UNKNOWN = "und"


@dataclass(frozen=True)
class Params:
    """``length``: n-grams of a profile. ``rows``: labelled rows a language
    that the profiles are counted on, chosen by a hash of the id (expected
    number; all, if fewer). All values of lang are learned; with more than
    ``languages`` of them the column holds no languages, which is an error."""

    length: int = 400
    rows: int = 4000
    languages: int = 20_000


_LETTER: list[np.ndarray] = []


def letters(text: str) -> np.ndarray:
    """Code points of the lower-case letters, 1 for each run of others, with 1
    at both ends; empty without a letter."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    c = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    c = np.where(_LETTER[0][c], c, np.uint32(1))
    c = np.concatenate([[1], c, [1]]).astype(np.int64)
    c = c[np.concatenate([[True], (c[1:] != 1) | (c[:-1] != 1)])]
    return c if len(c) > 1 else c[:0]


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text, three code points of 21 bits to an integer,
    and their counts, in order of the integers."""
    c = letters(text)
    if not len(c):
        return c, c
    two = c[:-1] << 21 | c[1:]
    three = two[:-1] << 21 | c[2:]
    g = np.concatenate([c[c != 1], two, three])
    g.sort()
    first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    return g[first], np.diff(np.append(first, len(g)))


class Profiles:
    """For each n-gram the languages that have it, in order of the languages,
    and its ranks in them."""

    def __init__(self, lists: dict[str, list[int]], length: int):
        self.names, self.length = sorted(lists), length
        grams = np.array([g for name in self.names for g in lists[name]], np.int64)
        order = np.argsort(grams, kind="stable")
        self.grams, first = np.unique(grams[order], return_index=True)
        self.first = np.append(first, len(grams))
        self.langs = np.repeat(np.arange(len(self.names)), [len(lists[name]) for name in self.names])[order]
        self.ranks = np.concatenate([np.arange(len(lists[name])) for name in self.names] or [np.zeros(0, np.int64)])[order]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and 1 minus its share of the largest distance; equal
        distances go to the first name in order."""
        g, n = ngrams(text or "")
        if not len(g) or not self.names:
            return UNKNOWN, 0.0
        top = np.argsort(-n, kind="stable")[:self.length]
        g = g[top]
        at = np.minimum(np.searchsorted(self.grams, g), len(self.grams) - 1)
        place = np.flatnonzero(self.grams[at] == g)
        at = at[place]
        held = self.first[at + 1] - self.first[at]
        entry = np.arange(held.sum()) + np.repeat(self.first[at] - np.cumsum(held) + held, held)
        near = self.length - np.abs(self.ranks[entry] - np.repeat(place, held))  # what an n-gram in the profile spares of the largest distance
        far = self.length * len(g) - np.bincount(self.langs[entry], near, len(self.names))
        best = int(np.argmin(far))
        return self.names[best], float(1 - far[best] / (self.length * len(g)))


def fit(docs: DataFrame, p: Params = Params(), text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Profiles:
    """Profiles of all non-null languages of ``docs``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).filter("lang is not null")
    found = rows.groupBy("lang").count().limit(p.languages + 1).collect()
    if len(found) > p.languages:
        raise ValueError(f"{lang_col} has more than {p.languages} values")
    known = spark.createDataFrame(found, "lang string, count long")
    share = F.lit(2.0 ** 62) * 2 * F.least(F.lit(1.0), F.lit(float(p.rows)) / F.col("count"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, dict[int, int]] = defaultdict(lambda: defaultdict(int))
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                own = total[lang.as_py()]
                for g, n in zip(*(x.tolist() for x in ngrams(text.as_py() or ""))):
                    own[g] += n
        for lang, own in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(own.keys(), pa.int64()), pa.array(own.values(), pa.int64())], names=["lang", "g", "n"])

    # at most Params.languages rows, checked above
    sample = (rows.join(F.broadcast(known), "lang").filter(F.abs(F.xxhash64("id", F.lit(7))).cast("double") <= share).select("lang", "text"))
    summed = sample.mapInArrow(count, "lang string, g long, n long").groupBy("lang", "g").agg(F.sum("n").alias("n"))
    order = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "g"))
    lists: dict[str, list[int]] = {r[0]: [] for r in found}
    for r in summed.withColumn("r", order).filter(F.col("r") <= p.length).select("lang", "g", "r").orderBy("lang", "r").collect():
        lists[r[0]].append(r[1])
    return Profiles({k: v for k, v in lists.items() if v}, p.length)


def predicted(docs: DataFrame, profiles: Profiles, text_col: str = "text", to: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the language and the score of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)  # Params.length n-grams a language

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        p = shared.value
        return pd.DataFrame([p.predict(t) for t in texts], columns=["lang", "score"])

    tmp = "__language_of_text"
    while tmp in {c.lower() for c in docs.columns}:
        tmp += "_"
    return docs.withColumn(tmp, predict(F.col(text_col).cast("string"))).withColumn(to, F.col(tmp + ".lang")).withColumn(score, F.col(tmp + ".score")).drop(tmp)


def languages(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score), one for each row of ``docs``.

    Profiles come from the text and lang of rows that are not held out (crc32
    of the id as text modulo 4 is 2); a null id is held out of learning, not
    marked so. A null text, one without a letter, or no learned language at
    all: ``und`` with score 0. Rows that repeat are judged, and learned from, each for
    itself; texts are read whole, whatever their length. Other columns are not
    read. An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    profiles = fit(rows.filter(doc_split("doc_id", 4) != 2), p)
    return predicted(rows.drop("lang"), profiles).select(
        "doc_id", F.coalesce(doc_split("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@register("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(read_table(spark, sf_dir, "documents"))
