"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import (
    conversations,
    decontamination,
    fingerprints,
    html,
    jaccard,
    licenses,
    packing,
    quality,
    rules,
    tokens,
    toxicity,
    urls,
    variants,
)

# The rules that the URL query applies.
URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def tokenizer(name: str = "byte_bpe_50k.json") -> str:
    """The path of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), urls.rule_table(spark, URL_RULES))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer())


def op4_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.classes(table(spark, folder, "documents"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.count_tokens(table(spark, folder, "documents"), tokenizer())


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.report(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def op9_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    known = licenses.templates(spark, licenses.public_licenses())
    return licenses.scan(table(spark, folder, "documents"), known)


def op7_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages"))


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare(table(spark, folder, "documents"))


def op11_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge(table(spark, folder, "documents"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.group(table(spark, folder, "documents"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair(table(spark, folder, "conversations"))


def queries() -> dict:
    return {
        "op1_quality": op1_quality,
        "op2_url_filters": op2_url_filters,
        "op3_packing": op3_packing,
        "op4_ngram_jaccard": op4_ngram_jaccard,
        "op5_token_counts": op5_token_counts,
        "op6_decontamination": op6_decontamination,
        "op7_html_extraction": op7_html_extraction,
        "op8_fingerprints": op8_fingerprints,
        "op9_license_scans": op9_license_scans,
        "op10_toxicity": op10_toxicity,
        "op11_quality_rules": op11_quality_rules,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_conversation_repair": op13_conversation_repair,
    }
