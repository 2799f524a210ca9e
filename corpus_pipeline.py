"""Documents to packed training sequences, stage by stage.

Every stage takes the documents that the stage before kept and returns
documents again, all columns included; the last returns packed pieces.  ``run``
writes each stage's rows to the shared folder and reads them back, and deletes
them once the next stage is written.  Empty tables give empty stages; columns the
stages do not know, whatever their names, pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricelens.llm import jaccard_join, line_dedup, mixing, nbsvm, packing
from pricelens.llm.common import discard, settle, table
from pricelens.llm.queries import public_tokenizer

ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled ones among them, does not reject.

    A null or empty text has the score of the bias alone; a null id is never
    labelled; repeated rows are judged alike; without labels nothing is rejected.
    """
    return nbsvm.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines common to three documents stay in one of them.

    A null text stays null, a document that loses all lines stays with an empty
    text; rows of one id are one document; a null id is smaller than any other.
    """
    return line_dedup.drop_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays.

    The smallest id stays, a null id last; of repeated rows one stays; texts
    without words are in no group and all stay.
    """
    return jaccard_join.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    The null source is a source; texts without words fill nothing and are taken by
    their place; rows equal in every column are one with the copies of all.
    """
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences.

    A null or empty text is the end id alone; null ids stay null; repeated rows are
    packed each for itself.
    """
    return packing.pack(docs, **public_tokenizer())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", near_duplicates),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        done, docs = docs, settle(stage(spark, docs, sf_dir), f"stage-{name}")
        if name != STAGES[0][0]:
            discard(done)
    return docs
