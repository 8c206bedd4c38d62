"""Every registered query against its SQL on the small tables."""

import decimal

import duckdb
import pytest

import __spark_entry__ as entry_points
from attemptlog.registry.oracle import ORACLE
from attemptlog.registry.provenance import PROVENANCE
from attemptlog.registry.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return repr(round(float(value), 6))
    return str(value)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_same_rows(spark, sf, duck, key):
    df = entry_points.queries()[key](spark, sf)
    result = duck.execute(entry_points.oracle_sql()[key])
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    assert sorted(df.columns) == sorted(names)
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    order = sorted(names)
    got = sorted(tuple(plain(r[c]) for c in order) for r in df.collect())
    want = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in result.fetchall())
    assert got == want


def test_every_query_has_sql_and_provenance():
    assert set(QUERIES) == set(ORACLE) == set(PROVENANCE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert "resume_processing_stage" in df.columns
    assert df.count() == 378
