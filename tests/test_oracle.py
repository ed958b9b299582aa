"""Every registered query against its DuckDB oracle on the smallest tables."""
import pytest

import __spark_entry__ as entry
from tools_compare import same_rows

SF = "/root/testdata/sf0.001"
# the optional part has its own tests beside it
KEYS = sorted(entry.Q.REGISTRY)


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    got = entry.queries()[key](spark, SF).toPandas()
    want = duck.sql(entry.oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert same_rows(got, want), key


def test_entry_flagship(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["borough", "zone_name", "courses"]
    assert 0 < len(rows) <= 10
    counts = [r["courses"] for r in rows]
    assert counts == sorted(counts, reverse=True)
