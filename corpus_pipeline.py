"""A training corpus from ``documents`` in five stages, each one operator of ``anemoi.llm``.

Quality rules, near duplicates, decontamination, mixing, sharding. Every stage but the last
returns the columns of its input; ``run`` writes each result as Parquet in the shared
folder and rereads it as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anemoi.llm import decontaminate, mixing, near_dup, quality_rules, sharding
from anemoi.llm.common import saved, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule policy keeps."""
    return quality_rules.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8), the smallest id."""
    return near_dup.deduplicated(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: zero to three times."""
    return mixing.repeated(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix dealt into eight shards: the columns of documents, shard and slot."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("sharding", shards),
]

def _over(oracle: str, rows: str) -> str:
    """An operator's oracle with another table in place of ``documents``."""
    return oracle.replace("FROM documents", f"FROM {rows}")


ORACLE_SQL = f"""
WITH RECURSIVE s1 AS MATERIALIZED (
  SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM ({quality_rules.ORACLE}) WHERE kept)),
s2 AS MATERIALIZED (
  SELECT * FROM s1 WHERE doc_id IN (SELECT doc_id FROM ({_over(near_dup.oracle(5), "s1")}) WHERE kept)),
s3 AS MATERIALIZED (
  SELECT * FROM s2 WHERE doc_id NOT IN (SELECT doc_id FROM ({_over(decontaminate.ORACLE, "s2")}) WHERE contaminated)),
s4 AS MATERIALIZED (
  SELECT s3.*, unnest(range(copies)) AS copy FROM s3 JOIN ({_over(mixing.ORACLE, "s3")}) AS t ON t.doc_id = s3.doc_id),
s5 AS (SELECT * EXCLUDE (copy), row_number() OVER (ORDER BY doc_id, copy) - 1 AS no FROM s4)
SELECT * FROM ({sharding.permuted_sql("SELECT * FROM s5", "SELECT count(*) AS total FROM s4", "* EXCLUDE (no, k, n, total, half, mask)")})
"""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
