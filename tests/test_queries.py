"""Every registered query against its SQL counterpart, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from tools.check_oracle import comparable

SMALL = "/root/testdata/sf0.001"
NAMES = sorted(entry_point.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = entry_point.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    relation = duck.sql(entry_point.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    expected = comparable(relation.select(*[f'"{column}"' for column in columns]).fetchall())
    assert comparable(df.select(*columns).collect()) == expected


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
