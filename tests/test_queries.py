"""Every registered query against its SQL at the smallest scale."""

from __future__ import annotations

import os
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry_points
from check_queries import TABLES, normal, oracle

SF = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry_points.registry.QUERIES, entry_points.registry.SQL


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.skipif(not Path(SF).exists(), reason="given tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = Counter(tuple(normal(r[c]) for c in columns) for r in df.collect())
    names, _, rows = oracle(con, SQL[name])
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert found == Counter(tuple(normal(r[i]) for i in order) for r in rows)
