"""The corpus pipeline: STAGES over documents, each a function (spark, docs, sf_dir) -> DataFrame.

Quality classifier, line dedup, n-gram Jaccard near duplicates, personal data,
best-fit packing. Every stage but the last returns the columns of documents;
its result is written as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import materialize
from corpusflow.llm.line_dedup import dedup_lines
from corpusflow.llm.ngram_join import near_unique
from corpusflow.llm.packing import default_tokenizer, pack
from corpusflow.llm.pii import redact
from corpusflow.llm.quality import score_quality

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents, n_chars counted anew (null for a null text)."""
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores 0.3 or more; the rest go.

    A null text is scored as an empty one; repeated rows and ids are scored each; with no labels all stay. No rows
    in, no rows out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_quality(docs, labels).where("predicted = 1").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines, but for the copy in the largest doc_id.

    A null text becomes ''. Rows that repeat a doc_id are one document to the count; a null doc_id is one too. Texts
    that lose all lines stay, as ''."""
    return _documents(dedup_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each class of five-word Jaccard 0.8 or more.

    Texts without words and rows of a null doc_id are in no class and stay, as do all rows of a doc_id that is kept."""
    return near_unique(docs, 5, 80, 100).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind in brackets; a null text stays null, every row stays."""
    return _documents(redact(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their slots in sequences of 1024 tokens; a null or empty text is the end token
    alone, rows that repeat a doc_id are packed each. No rows in, no rows out."""
    return pack(docs, default_tokenizer())


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: The classifier and the tokenizer have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to documents, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{name}")
    return docs
