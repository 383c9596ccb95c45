"""Registered queries of the training-data operators.

Each takes ``(spark, sf_dir)``, reads whole tables, applies one operator with
its production parameters and derives the contract's columns from the
operator's own output. The two audits have an oracle; SQL cannot express the
others, so ``tests/llm`` holds them against brute force instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import divergence, filteraudit

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@register
def op1_repair_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.repair import encode_documents
    return encode_documents(documents(spark, sf_dir), tokenizer_path())


@register
def op3_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.pii import pii_report
    return pii_report(documents(spark, sf_dir))


@register
def op4_mixture_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.mixture import mixture_report
    return mixture_report(documents(spark, sf_dir))


@register
def op7_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.multiset import fingerprint_report
    return fingerprint_report(documents(spark, sf_dir))


@register
def op5_setsketch_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.setsketch import near_duplicate_report
    return near_duplicate_report(documents(spark, sf_dir), width=4, percent=80)


@register
def op6_secret_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.secrets import secret_report
    return secret_report(documents(spark, sf_dir))


@register
def op8_language_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.langid import language_report
    return language_report(documents(spark, sf_dir))


@register
def op2_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.chunks import repeated_passages
    return repeated_passages(documents(spark, sf_dir))


@register
def op9_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.kneserney import language_model_report
    return language_model_report(documents(spark, sf_dir))


@register
def op10_decontaminate_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.decontaminate import find_leaks
    return find_leaks(documents(spark, sf_dir), benchmark(spark, sf_dir))


@register
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.filter_audit(spark, f"{sf_dir.rstrip('/')}/documents.parquet", table(spark, sf_dir, "labels"))


@register
def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.chatformat import chat_report
    return chat_report(table(spark, sf_dir, "conversations"))


@register
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence_report(documents(spark, sf_dir))


ORACLE["op11_filter_audit"] = filteraudit.oracle_sql()
ORACLE["op13_source_divergence"] = divergence.oracle_sql()
