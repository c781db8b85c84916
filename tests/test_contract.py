"""Every named query against its SQL twin in an independent engine."""

import duckdb
import pytest

from __spark_entry__ import entry
from salesloom.contract.oracle import ORACLE
from salesloom.contract.registry import bound_queries
from tests.conftest import SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    return connection


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, v if v is not None else 0) for v in row))


def test_every_query_has_a_twin():
    assert set(bound_queries()) == set(ORACLE)


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(bound_queries()))
def test_query_equals_sql(spark, duck, name):
    df = bound_queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    result = duck.execute(ORACLE[name])
    described = {d[0]: str(d[1]) for d in result.description}
    assert sorted(described) == columns
    assert {c: KINDS[k] for c, k in df.dtypes} == described
    order = [list(described).index(c) for c in columns]
    expected = [tuple(row[i] for i in order) for row in result.fetchall()]
    actual = [tuple(row) for row in df.select(*[f"`{c}`" for c in columns]).collect()]
    assert _sorted(actual) == _sorted(expected)
    assert expected, "the twin finds rows, so the comparison means something"
