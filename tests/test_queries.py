"""Every registered query against its check SQL in DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from content_signals.catalog import QUERIES
from content_signals.oracle import SQL

TABLES = ["documents", "labels", "events", "pages"]
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield con
    con.close()


def _sorted(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = [tuple(row[c] for c in columns) for row in df.collect()]
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    want = [tuple(row[names.index(c)] for c in columns) for row in result.fetchall()]
    assert sorted(names) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    assert len(got) > 0
    assert _sorted(got) == _sorted(want)


def test_entry(spark):
    assert entry(spark).count() > 0
