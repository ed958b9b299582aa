"""Queries with an SQL twin against it, and all queries on empty tables."""
import duckdb
import pytest
from pyspark.sql import types as T

import corpus_pipeline
from ridelake.llm import queries as L

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


def rows(df):
    cols = sorted(df.columns)
    plain = df[cols].astype(object).where(df[cols].notna(), None).values.tolist()
    # pandas makes doubles of whole numbers beside a null
    return cols, sorted(repr([int(x) if isinstance(x, float) and x.is_integer() else x for x in row]) for row in plain)


@pytest.mark.parametrize("key", sorted(L.ORACLES))
def test_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert rows(L.QUERIES[key](spark, SF).toPandas()) == rows(con.sql(L.ORACLES[key]).df())


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in L.QUERIES) == list(range(1, 14))


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for t in TABLES:
        schema: T.StructType = spark.read.parquet(f"{SF}/{t}.parquet").schema
        spark.createDataFrame([], schema).write.parquet(f"{d}/{t}.parquet")
    return d


@pytest.mark.parametrize("key", [*sorted(L.QUERIES), "pipeline"])
def test_empty_tables(spark, empty_dir, key):
    f = corpus_pipeline.run if key == "pipeline" else L.QUERIES[key]
    assert f(spark, empty_dir).collect() == []
