"""Every registered query against the same in SQL, on the smallest tables."""

import glob
import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry
from oracle_sql import ORACLE


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(repr(float(r[i])) if isinstance(r[i], (int, float)) else repr(r[i]) for i in order) for r in rows),
    )


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


#: Queries of the training-data part have their own tests, in a folder of their own.
OWN = set(ORACLE)


def test_every_query_has_sql():
    rest = set(entry.queries()) - set(entry.llm.queries() if entry.llm else ()) - {"pipeline"}
    assert rest == OWN


@pytest.mark.parametrize("name", sorted(OWN))
def test_query(spark, sf_dir, database, name):
    got = entry.queries()[name](spark, sf_dir)
    expected = database.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in expected.description]
    assert sorted(got.columns) == sorted(columns)
    assert _rows(got.columns, got.collect()) == _rows(columns, expected.fetchall())


def test_entry(spark):
    assert "ImageNumber" in entry.entry(spark).columns
