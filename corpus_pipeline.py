"""The corpus pipeline: documents through five stages, each written before the next.

Quality rules drop repetitive and very short documents, one document of each group of near
duplicates stays, documents that hold benchmark passages go, personal data becomes
pseudonyms, and what is left is packed into sequences of tokens.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. Nulls, repeated rows and empty tables are handled as the operators'
docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.decontamination import without_contamination
from millrace.llm.near import without_near_duplicates
from millrace.llm.packing import pack
from millrace.llm.pseudonyms import with_pseudonyms
from millrace.llm.queries import PSEUDONYM_KEY, TOKENIZER, table
from millrace.llm.repetition import without_repetition
from millrace.llm.words import small_batches
from millrace.session import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return without_repetition(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contamination(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A pseudonym may be longer or shorter than its value, so n_chars is counted anew."""
    small_batches(spark)
    return with_pseudonyms(docs, PSEUDONYM_KEY).withColumn(
        "n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pack(docs, TOKENIZER)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

# Neither a suffix array nor the packing's dynamic programme can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, applied to the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
