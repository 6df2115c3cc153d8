"""Every registered query with an oracle, and the pipeline, against DuckDB on the smallest driver tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
import corpus_pipeline
from anemoi.llm import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def text_rows(df, cols):
    return sorted(tuple("" if pd.api.types.is_scalar(v) and pd.isna(v) else str(v) for v in r)
                  for r in df[cols].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", [*sorted(catalog.ORACLE_SQL), "pipeline"])
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF).toPandas()
    duck.sql(E.oracle_sql()[name]).create_view(f"oracle_{name}")
    want = duck.sql(f"FROM oracle_{name}").df()
    assert sorted(got.columns) == sorted(want.columns)
    assert text_rows(got, sorted(got.columns)) == text_rows(want, sorted(got.columns))


def test_registered():
    ops = [q for q in E.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in ops) == list(range(1, 14))
    assert [s for s, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "mixing", "sharding"]


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema.simpleString() == docs.schema.simpleString()
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
