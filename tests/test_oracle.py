"""Every registered query against its SQL twin in DuckDB."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry
from panelspark.plans.oracle import oracle_sql
from panelspark.plans.registry import REGISTRY

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
ORACLES = oracle_sql()


@pytest.fixture(scope="session")
def duck(sf_dir):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf_dir, t)}.parquet'")
    return connection


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def ordered(rows):
    return sorted(
        (tuple(normal(v) for v in r) for r in rows),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    df = REGISTRY[name](spark, sf_dir)
    columns = sorted(df.columns)
    cursor = duck.execute(ORACLES[name])
    expected_columns = [c[0] for c in cursor.description]
    assert sorted(expected_columns) == columns
    places = [expected_columns.index(c) for c in columns]
    expected = ordered(tuple(r[i] for i in places) for r in cursor.fetchall())
    assert ordered(df.select(*[f"`{c}`" for c in columns]).collect()) == expected


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(ORACLES)


def test_entry_runs(spark):
    assert entry(spark).count() == 1335
