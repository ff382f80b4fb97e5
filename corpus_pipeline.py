"""From raw documents to encoded training data: five stages, each one of the library's operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallymill.llm import bpe_codec, line_quality, mixing, simhash, suffix_dedup
from tallymill.session import written
from tallymill.sources.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines the quality classifier takes for good."""
    return line_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs, simhash.near_duplicates(docs))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the strings of 200 bytes that occur elsewhere."""
    return suffix_dedup.without_repeats(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix of sources takes them: some in part, some twice."""
    return mixing.take(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each row of the mix, and the text that they decode to."""
    return bpe_codec.encoded(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good),
    ("SimHash near-dedup", distinct),
    ("suffix-array dedup", without_repeats),
    ("mixing sources to target weights", mixed),
    ("BPE encoding and decoding", encoded),
]

#: SQL can express neither the classifier nor the fingerprints.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again by the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
