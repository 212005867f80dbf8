"""Queries of this package against their SQL, run by DuckDB on the same files."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from ebbmark.llm.queries import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    duck = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    frame = contract.queries()[name](spark, SF_DIR)
    result = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(frame.columns)
    expected = Counter(result.fetchall())
    actual = Counter(tuple(row[c] for c in columns) for row in frame.collect())
    assert expected.total() > 0
    assert not expected - actual and not actual - expected
