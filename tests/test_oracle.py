"""Every registered query against its SQL on the same tables."""

import math

import duckdb
import pytest

from workload import all_queries
from workload.inputs import TABLES

QUERIES = all_queries()


@pytest.fixture(scope="module")
def duck(testdata):
    connection = duckdb.connect()
    connection.execute("SET timezone = 'UTC'")
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{testdata}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return repr(value)


def _sorted(rows, order):
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, testdata, name):
    query, text = QUERIES[name]
    frame = query(spark, testdata)
    assert text is not None
    expected = duck.execute(text)
    names = [column[0] for column in expected.description]
    assert sorted(frame.columns) == sorted(names)
    got = _sorted(frame.collect(), [frame.columns.index(n) for n in sorted(names)])
    want = _sorted(expected.fetchall(), [names.index(n) for n in sorted(names)])
    assert got == want
