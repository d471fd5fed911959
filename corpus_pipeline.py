"""Corpus pipeline: toxicity, language, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; its result is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mesura.llm import language_id, near_dedup, packing, toxicity
from mesura.llm.common import doc_split, read_table, shared_table, ship


def unused(name: str, docs: DataFrame) -> str:
    """``name``, longer where ``docs`` has such a column (whatever its case)."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity is below the threshold. Labels of rows with
    crc32(doc_id) divisible by 5 are not learned from. Null and empty texts
    have the score of a text without hits; rows that repeat are kept or go
    each for itself; very long texts are read whole."""
    ship(spark)
    p = toxicity.Params()
    labels = read_table(spark, sf_dir, "labels").filter(doc_split("doc_id", 5) != 0)
    model = toxicity.fit(docs, labels, p)
    score = unused("__toxicity", docs)
    return toxicity.scored(docs, model, to=score).filter(F.col(score) < p.threshold).select(*docs.columns)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a text in which a learned language is found; a null text, one
    without a letter and one whose distance is the largest there is (score 0:
    none of its n-grams is in any profile, as in a script that no language
    has) go. Rows that repeat are kept or go each for itself; very long texts
    are read whole."""
    ship(spark)
    profiles = language_id.fit(docs.filter(doc_split("doc_id", 4) != 2))
    lang, score = unused("__language", docs), unused("__language_score", docs)
    named = (F.col(lang) != language_id.UNKNOWN) & (F.col(score) > 0)
    return language_id.predicted(docs, profiles, to=lang, score=score).filter(named).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least
    id, and of rows that repeat that id the one with the least text. Rows with
    a null id stay."""
    ship(spark)
    own, nth = unused("__kept", docs), unused("__nth", docs)
    kept = near_dedup.near_duplicates(docs).filter("kept and doc_id is not null").select(F.col("doc_id").alias(own)).distinct()
    rows = docs.join(kept, F.col("doc_id") == F.col(own), "left_semi")
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    one = rows.withColumn(nth, first).filter(F.col(nth) == 1).select(*docs.columns)
    return one.union(docs.filter(F.col("doc_id").isNull()))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences. A null or empty
    text is the end id alone; rows that repeat are packed each for itself."""
    ship(spark)
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("language_id", drop_unknown_language), ("near_dedup", drop_near_duplicates), ("packing", pack)]

#: Learned stages and sequence numbers have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared_table(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
