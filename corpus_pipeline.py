"""Corpus pipeline: documents in, packed training sequences out.

Defined cases, for every stage: a null text is the empty one and is kept where nothing rejects it;
rows without an id are kept, as no decision names them; rows that repeat an id share its decision,
and after the near-duplicate stage each id has one row; an empty table gives an empty table; columns
beyond those of ``documents`` are left behind.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read back as the
documents of the next one. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from throngcast.llm import decontamination, near_dedup, packing, pii, quality_classifier
from throngcast.llm.common import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Similarity of near duplicates in percent, over shingles of five words.
SIMILARITY = 80


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose id is not among ``ids``; rows without an id stay.

    Few ids are broadcast, after their number is known; more are joined by shuffle.
    """
    ids = stored(ids.select("doc_id").where(F.col("doc_id").isNotNull()).distinct(), "dropped")
    few = ids.count() <= near_dedup.BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_anti").select(*COLUMNS)


def _one_row_per_id(docs: DataFrame) -> DataFrame:
    """Of rows that repeat an id the one stays whose text has the smallest hash, then the smallest
    columns: the same at every run. Texts move only where ids are repeated."""
    repeated = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    if repeated.isEmpty():
        return docs
    rows = docs.join(repeated, "doc_id", "left_semi")
    first = rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("_h"), *COLUMNS[1:])).alias("_row"))
    return _without(docs, repeated).unionByName(first.select("doc_id", "_row.*").select(*COLUMNS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    judged = quality_classifier.classify(docs, _table(spark, sf_dir, "labels"))
    return _without(docs, judged.where(~F.col("kept")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    classes = near_dedup.classes(docs, percent=SIMILARITY)
    return _one_row_per_id(_without(docs, classes.where(~F.col("kept"))))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    flagged = decontamination.flag(docs, _table(spark, sf_dir, "benchmark"))
    return flagged.where(~F.col("contaminated")).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in place."""
    masked = pii.mask(docs).withColumn("n_chars", F.length("text").cast("long"))
    return masked.select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: SQL cannot express the models, the tokens or the masks; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
