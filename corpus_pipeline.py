"""The corpus pipeline: stages over documents, each written and read again before the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pagefold.llm import bpe, exact_dedup, mixing, simhash, toxicity
from pagefold.llm.common import fresh_path, remove, table, tidied, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the machine doesn't find toxic; it learns from the labels of rows not held out."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("simhash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe encoding", encode),
]

#: SQL can express neither the kernel machine nor the fingerprints' components nor the encoding.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. A stage's intermediates and the input that it was written from are deleted once it is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, name.replace(" ", "-"))
        with tidied(spark, path):
            docs = written(stage(spark, docs, sf_dir), name, path)
        if before:
            remove(spark, before)
        before = path
    return docs
