"""The named queries of this folder, each over its whole table, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import chat, decontamination, negatives, urls
from millrace.llm.cotraining import quality_classifier
from millrace.llm.html import extracted
from millrace.llm.licenses import license_scan
from millrace.llm.near import near_duplicates
from millrace.llm.packing import pack
from millrace.llm.pseudonyms import pseudonyms
from millrace.llm.repetition import repetition
from millrace.llm.token_files import read_token_files, write_token_files
from millrace.llm.whitening import whitened
from millrace.llm.words import small_batches
from millrace.session import new_folder

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

# Fixed so that results can be compared. A real corpus needs a secret key of its own.
PSEUDONYM_KEY = b"a key for tests and examples"

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_benchmark_decontamination", decontamination.SQL)
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_text_density")
def text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


@query("op3_boundary_packing")
def boundary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), TOKENIZER)


@query("op4_cotraining_quality")
def cotraining_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_feistel_pseudonyms")
def feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


@query("op6_fuzzy_licenses")
def fuzzy_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


@query("op7_suffix_repetition")
def suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(table(spark, sf_dir, "documents"))


@query("op9_ngram_jaccard")
def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_url_expressions", urls.SQL)
def url_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"), urls.rule_table(spark))


@query("op10_schema_chat", chat.SQL)
def schema_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    marked = spark.createDataFrame(
        list(chat.MARKED), "conv_id long, turn long, role string, text string")
    return chat.chat_digests(rows.unionByName(marked, allowMissingColumns=True))


@query("op11_shifted_cholesky_whitening")
def shifted_cholesky_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


@query("op12_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), folder, BYTE_TOKENIZER)
    return read_token_files(spark, folder)


@query("op13_hard_negatives", negatives.SQL)
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(
        table(spark, sf_dir, "embeddings"), label, F.col("vec_id") % 100 == 0)
