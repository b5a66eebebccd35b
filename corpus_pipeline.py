"""The corpus pipeline: rules, near duplicates, repeated substrings, mixing, tokens. Each stage works on all that the one before kept.

Any column may be null, tables may be empty, rows repeated, and further columns are left out, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomlex.llm import bpe, mixing, quality, simhash, substring
from loomlex.llm.common import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps; null and empty texts break it. Repeated rows are judged alike and stay repeated."""
    return quality.keep_good(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies: five-word shingles, a similarity of 0.8 or more.

    First is the one with the least id; a null id comes last, ties go by a hash of id and text, and of equal rows one stays.
    Different texts never stand for each other, whether their ids are the same or null.
    """
    docs = docs.select(*COLUMNS)
    return simhash.keep_one(docs, simhash.similar(docs))


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the spans that earlier documents hold; documents of which nothing stays go. A null id counts as the latest, and rows that share an id as one document."""
    return substring.dedup(docs.select(*COLUMNS))


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that one epoch of the target mix takes, within a budget of four fifths of all tokens; null languages and sources are leaves of their own, and rows that share an id, or have none, are told apart by their texts."""
    return mixing.mix(docs.select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, n_tokens and ids of each whole text; a null text has none."""
    return bpe.encode(docs, bpe.default_path(), "doc_id", "source", "lang")


STAGES = [
    ("quality_rules", rules),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", repeated_substrings),
    ("mixing", target_mix),
    ("bpe_tokens", tokens),
]
#: SQL expresses neither the links of similar texts nor the tokens; tests/llm/test_pipeline.py holds every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
