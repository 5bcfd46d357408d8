"""The corpus pipeline: quality rules, near-duplicates, repeated passages, packing. Part of the training-data subpackage.

Every stage takes an empty table, null ids and texts, repeated rows, and columns
of any names beside doc_id and text; all but the last return the columns they
were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import jaccard, packing, quality, suffixes
from millrace.llm.shared import documents, materialize
from millrace.llm.wordids import default_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go. Null and blank texts have no words and are rejected; repeated rows go or stay together."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of 5-word shingle sets with a similarity of 0.8 stays: the least doc_id, null ids last, ties by a hash of the text. Documents without words stay; of repeated rows one stays."""
    return jaccard.one_of_each(docs).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more stay with their first holder only, the least doc_id, null ids last; documents that lose all their words go. n_chars, if there, follows the text."""
    return suffixes.without_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens. Null texts are one piece with the end id; null ids stay null; repeated rows are packed each."""
    return packing.pack(docs, default_path())


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("packing", packed)]

#: Classes of similar sets and the tokenizer are beyond SQL here; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
