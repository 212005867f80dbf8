"""Every registered query against its SQL, run by DuckDB on the same files."""

import math
import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from ebbmark.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def bag(rows, order):
    def plain(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else value
        return value

    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    frame = contract.queries()[name](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Window"):
        assert node not in plan, plan
    result = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(frame.columns)
    expected = bag(result.fetchall(), range(len(columns)))
    actual = bag(frame.collect(), [frame.columns.index(c) for c in columns])
    missing, extra = expected - actual, actual - expected
    assert not missing and not extra, (
        f"{missing.total()} missing, {extra.total()} extra of {expected.total()}: "
        f"{list(missing)[:3]} / {list(extra)[:3]}"
    )
    assert expected.total() > 0


def test_every_query_has_sql():
    assert QUERIES.keys() <= contract.queries().keys()
    assert QUERIES.keys() <= contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry_has_rows(spark):
    records = contract.entry(spark)
    assert records.columns == ["key", "value"]
    assert records.count() == 506 + 91 + 800
