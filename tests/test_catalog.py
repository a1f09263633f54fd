"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ledgerwatch.plans.catalog import entries

from .compare import difference

# Nothing in the smallest tables reaches these limits.
MAY_BE_EMPTY = {"structuring", "unknown_customer_rows"}


@pytest.fixture(scope="module")
def db(small):
    connection = duckdb.connect()
    for file in sorted(Path(small).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_sql():
    assert set(entries()) <= queries().keys() & oracle_sql().keys()


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entries()))
def test_query_matches_sql(spark, small, db, name):
    frame = queries()[name](spark, small)
    rows = frame.collect()
    twin = db.sql(oracle_sql()[name])
    problem = difference(frame.columns, rows, twin.columns, twin.fetchall())
    assert problem is None or (problem == "both are empty" and name in MAY_BE_EMPTY)
