"""Every registered query against its SQL twin in another engine."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver

from conftest import SF


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_matches_sql(spark, sql, name):
    df = driver.queries()[name](spark, SF)
    columns = sorted(df.columns)
    cursor = sql.execute(driver.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    expected = Counter(tuple(row[i] for i in at) for row in cursor.fetchall())
    found = Counter(tuple(row) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    assert found == expected and found


def test_entry(spark):
    found = driver.entry(spark)
    assert found.columns == ["referrer", "resource", "type", "count"]
    counts = [r["count"] for r in found.collect()]
    assert len(counts) == 20 and counts == sorted(counts, reverse=True)
