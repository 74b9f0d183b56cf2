"""The registered queries of this subpackage, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from merchant_ledger.llm import (
    language_model,
    mixing,
    ngram_join,
    packing,
    periodic_runs,
    pii,
    quality_classifier,
    quality_rules,
    secret_scan,
    tokenizer_alignment,
    toxicity,
    url_filters,
    vector_search,
)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.op1(documents(spark, folder))


def vocabulary() -> packing.Vocabulary:
    import public_tokenizers as files

    return packing.Vocabulary(files.path("byte_bpe_50k.json"), files.path("byte_bpe_50k.tiktoken"), files.PATTERN)


def op4_pack_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder), vocabulary())


def op7_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.op7(documents(spark, folder))


def op2_deobfuscated_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.op2(documents(spark, folder))


def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.op3(documents(spark, folder))


def op5_vector_search(spark: SparkSession, folder: str) -> DataFrame:
    return vector_search.op5(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.op6(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.op8(documents(spark, folder))


def op9_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.op9(documents(spark, folder))


def op10_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.op10(spark.read.parquet(f"{folder}/pages.parquet"))


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.op11(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.op12(documents(spark, folder))


def tokenizers() -> tokenizer_alignment.Tokenizers:
    import public_tokenizers as files

    return tokenizer_alignment.Tokenizers(vocabulary(), files.path("piece_bpe_32k.model"))


def op13_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return tokenizer_alignment.op13(documents(spark, folder), tokenizers())


QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources,
        op2_deobfuscated_pii,
        op3_secret_scan,
        op4_pack_sequences,
        op5_vector_search,
        op6_quality_classifier,
        op7_ngram_join,
        op8_quality_rules,
        op9_language_model,
        op10_url_filters,
        op11_toxicity,
        op12_periodic_runs,
        op13_tokenizer_alignment,
    )
}
ORACLE = {"op1_mix_sources": mixing.ORACLE}
