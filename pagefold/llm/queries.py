"""The queries of this subpackage: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pagefold.llm import bpe, exact_dedup, html_extract, knn, mixing, secrets, simhash, token_counts, token_store, toxicity
from pagefold.llm.common import table

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def vocab(name: str) -> str:
    return public_tokenizers.path(name)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocab(BYTE_BPE))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), vocab(BYTE_BPE))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.search(table(spark, sf_dir, "embeddings"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"), secrets.train(secrets.samples(spark)))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.read(token_store.write(table(spark, sf_dir, "documents"), vocab(WORD_BPE), end_id=2))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": op1,
        "op2_html_extract": op2,
        "op3_bpe": op3,
        "op4_exact_dedup": op4,
        "op5_simhash": op5,
        "op6_mixing": op6,
        "op7_knn": op7,
        "op8_secrets": op8,
        "op9_toxicity": op9,
        "op10_token_store": op10,
    }


#: Equal texts by the group of their lower-cased bytes.
EXACT_SQL = """
with plain as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
  doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from plain
"""


def oracle_sql() -> dict[str, str]:
    """What SQL can express; the other queries are tested against brute force."""
    return {"op4_exact_dedup": EXACT_SQL, "op6_mixing": mixing.SQL, "op7_knn": knn.SQL}
