"""Every registered query against its SQL, at the smallest scale."""

import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_DIR

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
          " labels conversations").split()
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(table):
    table = table.read_all() if hasattr(table, "read_all") else table
    columns = sorted(table.column_names)
    data = table.select(columns).to_pydict()

    def plain(value):
        return float(value) if isinstance(value, decimal.Decimal) else value

    return columns, sorted(tuple(repr(plain(v)) for v in row) for row in zip(*[data[c] for c in columns]))


def type_names(table):
    table = table.read_all() if hasattr(table, "read_all") else table
    named = {f.name: str(f.type).replace("large_", "").split("[")[0] for f in table.schema}
    return dict(sorted(named.items()))


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    ours = QUERIES[name](spark, SF_DIR).toArrow()
    theirs = duck.sql(ORACLE[name]).arrow()
    theirs = theirs.read_all() if hasattr(theirs, "read_all") else theirs
    assert type_names(ours) == type_names(theirs)
    assert comparable(ours) == comparable(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_gives_rows(spark, name):
    assert not QUERIES[name](spark, SF_DIR).isEmpty()


def test_entry(spark):
    assert entry.entry(spark).columns == ["event_date", "fire_count", "avg_frp", "max_frp", "night_fires"]
