"""The corpus pipeline: documents through five of the training-data operators.

Each stage is ``f(spark, docs, sf_dir)``; its result is written as Parquet in the shared folder and read again as the next
stage's ``docs``. A stage works on all that its predecessor kept. All but the last return the columns of documents. Once a
stage's result is written, the tables it was made from are deleted: a run leaves the last result only.

Defined cases are those of the operators: NULL and letterless texts go at language ID; an empty table stays empty; of rows that
repeat id and text one stays after exact dedup; of equal texts the largest id stays, of near copies the smallest; texts of any
length are worked on whole; further columns of the table are carried along untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import exact_dedup, language_id, mixing, near_dedup, sentencepiece_codec
from strata.llm.common import documents, release, stored, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a known language (operator 8). The classifier learns from the labelled documents at hand."""
    return language_id.keep_known(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id (operator 1)."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id (operator 3): five-word shingles, similarity 0.8."""
    return near_dedup.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources by weight (operator 10): a document once per take, the last one perhaps in part."""
    return mixing.materialise(docs, mixing.mix(docs))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's SentencePiece ids and the check of their decoding (operator 6)."""
    return sentencepiece_codec.encode_and_check(docs).drop("text")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: SQL cannot express the trained classifier or the tokenizer; the tests compare run() with a plain-Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, read = documents(spark, sf_dir), []
    for name, stage in STAGES:
        with written() as folders:
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(spark, read + folders[:-1])  # the stage's own tables and its predecessor's result, now that its result is written
        read = folders[-1:]
    return docs
