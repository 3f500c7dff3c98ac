"""A training corpus from raw documents: five stages, each over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import langid, linedup, mixing, simhash, transducer
from tripflow.llm.common import scratch_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document whose best language is less likely than this is rejected, as is one without any letter.
MIN_LANGUAGE_SCORE = 0.5


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a determined language, which becomes their lang. The model is fitted on the labelled documents of docs."""
    found = langid.predict(_documents(docs), langid.fit(docs))
    determined = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return _documents(found.where(determined).withColumn("lang", F.col("lang_pred")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many share; n_chars follows the text."""
    kept = linedup.drop_common_lines(_documents(docs))
    return _documents(kept.withColumn("n_chars", F.char_length("text").cast("long")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return _documents(simhash.keep_one(_documents(docs)))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, in a global random order."""
    return _documents(mixing.mix(_documents(docs)))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    compiled = transducer.compiled()
    both = transducer.encode_and_decode(_documents(docs), compiled)
    return both.select(
        "doc_id", "lang", "source", "n_chars", F.size("pieces").alias("n_pieces"), "pieces",
        F.col("text").eqNullSafe(F.col("decoded")).alias("round_trip"),
    )


STAGES = [
    ("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("source_mix", source_mix),
    ("sentencepiece", encode),
]

#: SQL has no counterpart of the models, fingerprints and pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is stored in the shared folder before the next begins, so that lost executors cost
    tasks of one stage only."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = scratch_dir(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
