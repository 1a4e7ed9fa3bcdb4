"""A training corpus from raw documents: quality rules, near-duplicate join, substring dedup, PII, packing.

Each stage works on all that its predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossweave.llm import common, jaccard_join, packing, pii, quality_rules, substring_dedup
from glossweave.llm.token_counts import vocabulary_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _with_text(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("text", F.col(text)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; of the others, the lines that fail go."""
    return _with_text(quality_rules.clean(docs).where("kept"), "cleaned")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays; ids may be null or repeated."""
    return jaccard_join.one_of_each(docs).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that repeat an earlier window go; documents with none left go."""
    return _with_text(substring_dedup.remove_repeats(docs).where("kept_text <> ''"), "kept_text")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind."""
    return _with_text(pii.detect(docs), "redacted")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all pieces with their place in a sequence."""
    return packing.pack(docs, vocabulary_path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("PII", personal_data),
    ("best-fit packing", packed),
]

#: Tokens and packing have no form in SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents; what each returns is written to the shared folder and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = common.cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
