"""Every registered query against its SQL on the smallest tables."""

import glob
import math
import os
from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as entry
from kerbside.plans import incident_queries, reading_queries, stream_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
# The corpus operators have tests of their own.
GROUPS = (reading_queries, incident_queries, stream_queries)
QUERIES = {name: query for group in GROUPS for name, query in group.QUERIES.items()}
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def results(spark):
    """All queries, a few at a time: small ones mostly wait for the planner."""

    def run(name):
        df = QUERIES[name](spark, SF_DIR)
        return df.columns, df.collect()

    with ThreadPoolExecutor(4) as pool:
        yield {name: pool.submit(run, name) for name in sorted(QUERIES)}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(results, con, name):
    found, collected = results[name].result()
    rows = as_rows(found, collected)
    assert rows
    if name in SQL:
        result = con.execute(SQL[name])
        columns = [d[0] for d in result.description]
        assert sorted(columns) == sorted(found)
        assert rows == as_rows(columns, result.fetchall())


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) <= set(SQL)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["time", "vehicles"]
