"""The corpus pipeline: five stages over `documents`, each one operator of ``caretrail.llm``.

language id (texts with a decided language stay), quality classifier (score 0.3 or more stays), near
duplicates (one document of each group stays), benchmark decontamination (documents with a test item
go), packing (pieces of sequences of 4096 tokens). Every stage works on all that its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from caretrail.llm import decontamination, language_id, near_dedup, packing, quality_classifier
from caretrail.llm.common import Stages, ship, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a decided language. Rows with a null text, or one without a letter, go; the model learns from
    the labelled rows of ``docs``; repeated rows are judged alike; all columns stay."""
    ship(spark)
    return language_id.known_language(docs, language_id.train(docs))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.3 or more. A null or empty text has the score of a text without n-grams; repeated
    rows are judged alike; all columns stay."""
    ship(spark)
    return quality_classifier.good_quality(docs, quality_classifier.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group (:func:`caretrail.llm.near_dedup.one_of_each`)."""
    ship(spark)
    return near_dedup.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Rows without a text hold none and stay; all columns stay."""
    ship(spark)
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, one row a piece. A null text is packed as its end token; rows with a null or repeated
    doc_id are documents of their own; other columns are not read."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language), ("quality_classifier", quality), ("near_dedup", near_duplicates),
          ("decontamination", decontaminated), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    stages = Stages(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stages.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: trained classifiers and a tokenizer are beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
