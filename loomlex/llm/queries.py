"""The thin queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, divergence, licenses, media, mixing, pages, periodic, quality, simhash, substring, tokenfile, toxicity, urlfilter
from .common import table


def op1_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.write_and_read(table(spark, sf_dir, "documents"), tokenfile.default_path())


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.match(table(spark, sf_dir, "pages"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op5_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality.failed("base").alias("base_failed"), "kept", F.col("failures").alias("failure_bits"),
    )


def op6_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), bpe.default_path())


def op7_media_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.store_and_read(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(table(spark, sf_dir, "documents"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op3_url_filter": urlfilter.ORACLE, "op5_quality_ledger": quality.ORACLE, "op9_substring_dedup": substring.ORACLE, "op10_mix_sources": mixing.ORACLE, "op12_source_divergence": divergence.ORACLE}
