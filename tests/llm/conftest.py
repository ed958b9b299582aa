import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_schema():
    return "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark, docs_schema):
    """Nulls in every column, empty and blank texts, repeated rows, ties."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [(1, "a b c " * 40, "en", "s1", 1), (1, "a b c " * 40, "en", "s1", 1), (2, None, None, None, None), (3, "", "en", "s1", 0),
            (None, "x y z", "en", "s2", 5), (None, "x y z", "en", "s2", 5), (None, None, None, None, None), (4, " \t\n\x0b ", "fr", "s2", 5),
            (5, long, "en", "s1", len(long)), (6, "z" * 5000, "en", "s1", 5000), (7, "déjà vu … 日本語 😀", "fr", "s1", 16),
            (8, " ".join(f"clean{i}" for i in range(80)), "en", "s3", 600), (-9, "password = hunter22", "en", "s3", 19)]
    return spark.createDataFrame(rows, docs_schema)
