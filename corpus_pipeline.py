"""Corpus preparation over ``documents``: language id, near-dedup, decontamination, PII masking, packing.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written
as Parquet and read again as the next stage's documents. All but the last
return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum.llm import decontam, langid, neardup, packing, pii
from aurum.llm.common import materialise, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: a document whose best language is less probable than this is rejected
LEAST_SCORE = 0.5


def _documents(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without letters or of no clear language go."""
    model = langid.fit(docs.where(~langid.held_out()))
    found = langid.predict(docs, model)
    return found.where((F.col("lang_pred") != langid.UNDEFINED) & (F.col("score") >= LEAST_SCORE)).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: that of the smallest id, or a nameless one where no row has an id."""
    return neardup.one_of_each(docs.select(COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts; a document left without a word goes."""
    found = decontam.find(docs, table(spark, sf_dir, "benchmark"))
    left = (F.col("n_words") > decontam.n_hit()) | (F.size("spans") == 0)
    return _documents(decontam.remove_hits(found.where(left)))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by ``[PII]``."""
    return _documents(pii.mask(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 places: one row per piece."""
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mask_pii", mask_pii), ("pack", pack)]

#: the tokenisers and models of the stages cannot be written in SQL; tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
