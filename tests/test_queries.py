"""Every registered query with a SQL counterpart, compared on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


def normal(pdf):
    pdf = pdf[sorted(pdf.columns)].copy()
    for c in pdf.columns:
        if str(pdf[c].dtype).startswith("datetime"):
            pdf[c] = pdf[c].astype("datetime64[us]")
    return pdf.sort_values(by=list(pdf.columns), ignore_index=True)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    got, expected = normal(entry.queries()[name](spark, DIR).toPandas()), normal(con.sql(entry.oracle_sql()[name]).df())
    assert list(got.columns) == list(expected.columns)
    assert len(got) == len(expected) > 0
    for c in got.columns:
        assert ((got[c] == expected[c]) | (got[c].isna() & expected[c].isna())).all(), c


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
