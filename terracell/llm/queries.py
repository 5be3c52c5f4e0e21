"""The corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracell.llm import decontaminate, exact_dedup, hard_negatives, merkle, mixing, oracles, pseudonyms, quality, sentence_spans, simhash, suffixes, token_counts, token_files, toxicity
from terracell.llm.common import documents, scratch_path
from terracell.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# For trials; a user gives an own secret.
PSEUDONYM_KEY = "trial key"


def query(name: str, sql: str | None = None) -> Callable:
    def add(run: Callable[[SparkSession, str], DataFrame]) -> Callable:
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return run(spark, sf_dir)

        QUERIES[name] = shipped
        if sql is not None:
            ORACLES[name] = sql
        return shipped

    return add


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def encode_to_files(docs: DataFrame) -> DataFrame:
    """Per document, read back from token files: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    manifest = token_files.write_token_files(docs, scratch_path(spark, "tokens"), public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_token_files(spark, manifest)


@query("op1_mixing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(documents(spark, sf_dir))


@query("op2_simhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


@query("op3_token_files")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_to_files(documents(spark, sf_dir))


@query("op4_pseudonyms")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymize(documents(spark, sf_dir), PSEUDONYM_KEY)


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


RULES = quality.Rules()


@query("op6_quality", oracles.quality_sql(RULES.min_words, RULES.repeat_words, RULES.ngram_chars, RULES.line_chars, RULES.symbols))
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(documents(spark, sf_dir), RULES)


SPANS = {"several": 2, "words": 12, "lone": 25}


@query("op7_sentence_spans", oracles.spans_sql(**SPANS))
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.drop_repeated_spans(documents(spark, sf_dir), **SPANS)


@query("op8_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query("op9_substrings", oracles.removal_sql(100))
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removal_report(documents(spark, sf_dir))


@query("op10_decontamination")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, sf_dir), benchmark(spark, sf_dir))


@query("op11_hard_negatives", oracles.negatives_sql(100, 5, 5, 80, 100, 256))
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors, 100, 5, 5, (80, 100), 256.0, label)


@query("op12_merkle", oracles.manifest_sql(7))
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_manifest(documents(spark, sf_dir), 7)


@query("op13_exact_dedup", oracles.duplicates_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(documents(spark, sf_dir))
